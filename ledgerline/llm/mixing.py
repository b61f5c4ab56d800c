"""Mixing sources to target weights, by blocks of a fixed number of words.

Each source's documents form one stream of words, cut into blocks of ``block`` words. The mix is a row of
slots, dealt to output shards of ``per_shard`` slots. How many slots of each shard a source gets is a
multinomial draw with the sources' shares, conditioned on each source's total, so that totals are
met: a pseudorandom permutation of all slots carries it out, slot by slot and without a driver loop. A
source's k-th slot takes block ``permutation(k mod blocks)`` of pass ``k // blocks``, with another
permutation for each source and pass. Permutations are keyed four-round Feistel networks, walked until
they land inside their range, so the same rows give the same mix.

Targets: sources by code point, null last, weigh ``WEIGHTS`` in turn; a target stops at ``most`` times its
source's words, and the excess is shared by weight until none is above.

Defined cases: a null or empty text has no words and is never taken; a null source is a source; rows
with the same id, source and text are numbered (``copy``), and each has its own words; an empty table gives
an empty mix.
Streams are laid out by buckets of documents, so a source with most rows is never one group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import BREAKS, WORD_BREAK, stored

WEIGHTS = (5, 2, 1)
BLOCK = 64
PER_SHARD = 1024
PER_BUCKET = 4096  # documents of a bucket of a source's stream, about


def words_of(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(BREAKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_BREAK, -1))


def targets(sources: DataFrame, most: int = 3, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Rows (source, source_size) -> also ``weight`` and ``target``. One row a source goes through one task.

    Sources that stop come first when ordered by cap / weight, so running sums find the level at which
    the rest share what is left.
    """
    cycle = F.array(*[F.lit(w) for w in weights])
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    ranked = (
        sources.withColumn("rank", F.row_number().over(order))
        .withColumn("weight", F.get(cycle, (F.col("rank") - 1) % len(weights)).cast("double"))
        .withColumn("cap", (F.col("source_size") * most).cast("double"))
        .withColumn("total", F.sum("source_size").over(everything).cast("double"))
    )
    leveled = ranked.withColumn(
        "level",
        (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest),
    ).withColumn("stops", F.col("cap") <= F.col("weight") * F.col("level"))
    # the first source that does not stop has the level of all that do not
    final = F.min(F.when(~F.col("stops"), F.struct("rank_fill", "level"))).over(everything)["level"]
    return (
        leveled.withColumn("rank_fill", F.row_number().over(fill))
        .withColumn("final", final)
        .withColumn("target", F.least("cap", F.coalesce(F.col("weight") * F.col("final"), F.col("cap"))))
        .select("source", "source_size", "rank", "weight", "target")
    )


def permuted(x: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Position of each x in a keyed permutation of 0 .. n - 1."""
    x, n, key = (np.asarray(v, np.uint64) for v in (x, n, key))
    half = np.uint64(1)
    bits = np.ceil(np.log2(np.maximum(n.astype(float), 2)) / 2 + 1e-9).astype(np.uint64)
    mask = (half << bits) - half
    out, todo = x.copy(), np.arange(len(x))
    while len(todo):
        left, right = out[todo] >> bits[todo], out[todo] & mask[todo]
        for turn in range(4):
            mixed = (right + key[todo]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(turn * 0x632BE5AB)
            mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
            left, right = right, left ^ ((mixed >> np.uint64(29)) & mask[todo])
        out[todo] = (left << bits[todo]) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


@F.pandas_udf(T.LongType())
def permutation(x: pd.Series, n: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permuted(x.to_numpy(), n.to_numpy(), key.to_numpy().astype(np.uint64)))


def streams(docs: DataFrame, seed: int = 0) -> DataFrame:
    """Documents with ``size`` and the place ``start`` of their first word in their source's stream."""
    sized = stored(
        docs.select(
            "doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("body"),
        ).groupBy("doc_id", "source", "body").agg(F.max("size").alias("size"), F.count("*").alias("copies"))
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))),
        "sized",
    )
    buckets = max(1, sized.count() // PER_BUCKET)
    dealt = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "body", F.lit(seed), F.when(F.col("copy") > 0, F.col("copy"))), F.lit(buckets)))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("source", "bucket").agg(F.sum("size").alias("n")).withColumn(
        "base", F.coalesce(F.sum("n").over(earlier), F.lit(0))
    )
    inside = (
        Window.partitionBy("source", "bucket").orderBy("doc_id", "body", "copy").rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        dealt.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(
            bases.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "base"),
            F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")),
        )
        .select("doc_id", "source", "body", "copy", "size", (F.col("base") + F.col("inside")).alias("start"))
    )


def slots(goals: DataFrame, block: int = BLOCK, per_shard: int = PER_SHARD, most: int = 3, seed: int = 0) -> DataFrame:
    """The mix: rows (shard, slot, rank, pass, block), one for each slot, from rows of :func:`targets`."""
    spark = goals.sparkSession
    counted = goals.where("source_size > 0").withColumn(
        "blocks", F.ceil(F.col("source_size") / block).cast("long")
    ).withColumn(
        "n",
        F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")), F.col("blocks") * most).cast("long"),
    )
    counted = stored(
        counted.withColumn(
            "first",
            F.coalesce(F.sum("n").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        ),
        "slot-counts",
    )
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # sources meet positions by chunks of positions, so many sources cost no more than their rows
    chunk = max(1024, total // 4096)
    ranges = counted.where("n > 0").withColumn(
        "chunk",
        F.explode(F.sequence(F.floor(F.col("first") / chunk), F.floor((F.col("first") + F.col("n") - 1) / chunk))),
    )
    return (
        spark.range(total)
        .withColumn("chunk", F.floor(F.col("id") / chunk))
        .join(ranges, "chunk")
        .where("id >= first and id < first + n")
        .withColumn("k", F.col("id") - F.col("first"))
        .withColumn("pass", F.floor(F.col("k") / F.col("blocks")))
        .withColumn("place", permutation("id", F.lit(total), F.abs(F.xxhash64(F.lit(seed)))))
        .withColumn(
            "block",
            permutation(F.col("k") % F.col("blocks"), "blocks", F.abs(F.xxhash64("rank", "pass", F.lit(seed)))),
        )
        .select(
            F.floor(F.col("place") / per_shard).alias("shard"),
            (F.col("place") % per_shard).alias("slot"),
            "rank", "pass", "block",
        )
    )


class Mix:
    """Streams, targets and slots of one table of documents."""

    def __init__(self, docs: DataFrame, block: int = BLOCK, most: int = 3, seed: int = 0):
        self.block, self.docs = block, docs
        placed = stored(streams(docs, seed), "streams")
        self.repeated = not placed.where("copy > 0").isEmpty()
        self.goals = stored(
            targets(placed.groupBy("source").agg(F.sum("size").alias("source_size")), most), "targets"
        )
        goal = self.goals.select(F.col("source").alias("s"), "rank", "source_size", "target")
        self.placed = placed.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s")
        self.slots = stored(slots(self.goals, block, most=most, seed=seed), "slots")

    def pieces(self) -> DataFrame:
        """One row for each document and block it has words in: words [low, high) of the document."""
        b, start, size = self.block, F.col("start"), F.col("size")
        return (
            self.placed.where("size > 0")
            .withColumn("block", F.explode(F.sequence(F.floor(start / b), F.floor((start + size - 1) / b))))
            .withColumn("low", F.greatest(F.lit(0), F.col("block") * b - start))
            .withColumn("high", F.least(size, (F.col("block") + 1) * b - start))
            .withColumn("at", start + F.col("low"))  # place in the source's stream
            .select("doc_id", "source", "body", "copy", "size", "rank", "block", "low", "high", "at")
        )

    def taken(self) -> DataFrame:
        """Words the mix takes of every document, repeats counted."""
        times = self.slots.groupBy("rank", "block").agg(F.count("*").alias("times"))
        words = (
            self.pieces().join(times, ["rank", "block"])
            .groupBy("doc_id", "body", "copy", "rank").agg(F.sum((F.col("high") - F.col("low")) * F.col("times")).alias("taken"))
        )
        key = ["doc_id", "body", "copy", "rank"]
        left = self.placed.alias("p").join(
            words.alias("w"),
            [F.col(f"p.{c}").eqNullSafe(F.col(f"w.{c}")) for c in key],
            "left",
        )
        return left.select("p.*", F.coalesce("w.taken", F.lit(0)).cast("long").alias("taken"))

    def _rows(self) -> DataFrame:
        """The input rows (row, own_body, number): equal ones of an id and source are numbered as in the streams."""
        whole = F.struct(*[F.col(f"`{c}`") for c in self.docs.columns]).alias("row")
        rows = self.docs.select(whole, F.xxhash64(F.coalesce("text", F.lit(""))).alias("own_body"))
        number = F.lit(0).cast("long")
        if self.repeated:
            equal = Window.partitionBy("row.doc_id", "row.source", "own_body").orderBy(F.xxhash64("row"))
            number = F.row_number().over(equal).cast("long") - 1
        return rows.withColumn("number", number)

    def packed(self) -> DataFrame:
        """The mix itself: rows (shard, slot, source, pass, n_words, text), a packed block of words for each slot.

        A block holds the next ``block`` words of its source's stream, across documents; the last one may hold fewer. Slots
        meet blocks by their index alone, so texts are cut once, however often a block is taken.
        """
        parts = F.collect_list(F.struct("low", "high", "block", "at")).alias("parts")
        got = self.pieces().groupBy("rank", "source", "doc_id", "body", "copy").agg(parts)
        rows = self._rows()
        on = (
            F.col("row.doc_id").eqNullSafe(got["doc_id"]) & (rows["own_body"] == got["body"])
            & (rows["number"] == got["copy"]) & F.col("row.source").eqNullSafe(got["source"])
        )
        by_text = rows.join(got, on).select("rank", "source", "parts", F.col("row.text").alias("text"))

        def cut(words: Column) -> Column:
            def piece(p: Column) -> Column:
                own = F.slice(words, (p["low"] + 1).cast("int"), (p["high"] - p["low"]).cast("int"))
                return F.struct(p["block"].alias("block"), p["at"].alias("at"), own.alias("words"))

            return F.transform("parts", piece)

        cuts = by_text.select("rank", "source", F.inline(F.transform(F.array(words_of(F.col("text"))), cut)[0]))
        blocks = cuts.groupBy("rank", "source", "block").agg(
            F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("at", "words"))), lambda p: p["words"])).alias("words")
        )
        return self.slots.join(blocks, ["rank", "block"]).select(
            "shard", "slot", "source", "pass", F.size("words").cast("long").alias("n_words"),
            F.array_join("words", " ").alias("text"),
        )

    def documents(self) -> DataFrame:
        """What the mix holds of each document, with the columns of documents: one row a pass.

        A pass that takes all words of a document keeps its text; else the taken words, joined by spaces.
        """
        got = (
            self.pieces().join(self.slots.select("rank", "block", "pass"), ["rank", "block"])
            .groupBy("doc_id", "body", "copy", "source", "size", "pass")
            .agg(
                F.sort_array(F.collect_list(F.struct("low", "high"))).alias("parts"),
                F.sum(F.col("high") - F.col("low")).alias("words"),
            )
        )
        rows = self._rows()
        on = (
            F.col("row.doc_id").eqNullSafe(got["doc_id"]) & (rows["own_body"] == got["body"])
            & (rows["number"] == got["copy"]) & F.col("row.source").eqNullSafe(got["source"])
        )
        parts = got["parts"]

        def joined(words: Column) -> Column:
            return F.array_join(
                F.flatten(F.transform(parts, lambda p: F.slice(words, (p["low"] + 1).cast("int"), (p["high"] - p["low"]).cast("int")))), " "
            )

        cut = F.transform(F.array(words_of(F.col("row.text"))), joined)[0]  # split once
        text = F.when(got["words"] == got["size"], F.col("row.text")).otherwise(cut)
        taken = rows.join(got, on).select("row", text.alias("text"))
        new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
        return taken.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in self.docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Digest columns of ``documents``."""
    return Mix(docs).taken().select("doc_id", "size", "source_size", "target", "taken")
