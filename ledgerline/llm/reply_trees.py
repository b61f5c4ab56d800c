"""Chat formatting: reply trees to conversations, by iterative self-joins.

Messages point to their parents. Joining the pointers with themselves doubles the distance each round, so
trees of any depth need a logarithmic number of joins. The doubled pointers carry the sum of scores up to the
root; leaves of a tree are ranked by that sum (ties by smaller leaf), and the messages of each chosen
path are found by joining down the same pointers. Each path becomes one formatted conversation.

Template of a turn: ``### role: text </turn>`` and a newline. Inside roles and texts a backslash is
doubled, and a backslash goes before ``###`` and ``</turn>`` (in roles also before ``:``), so every text can
be read back. ``loss`` lists the code-point ranges of the texts of the trained role.

Defined cases: null texts and roles are empty; a null conversation id is a conversation; a message whose
parent is missing is a root; messages that only reach themselves have no path and are left out; of
messages with one id in one conversation the first by role and text counts; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

NO_CONV = -(1 << 63)


def paths(messages: DataFrame, best: int = 1) -> DataFrame:
    """Rows (conv, leaf, rank, score, msg, back) from rows (conv, msg, parent, score).

    ``back`` counts steps from the leaf; ``best`` leaves of each conversation are chosen.
    """
    known = messages.select("conv", F.col("msg").alias("parent"), F.lit(True).alias("known"))
    jump = stored(
        messages.join(known, ["conv", "parent"], "left").select(
            "conv", "msg", F.when(F.col("known"), F.col("parent")).alias("up"), F.col("score").cast("double").alias("gain")
        ),
        "jump-0",
    )
    limit = jump.count().bit_length() + 1  # enough for the longest path there can be
    jumps = []
    while len(jumps) < limit and not jump.where("up is not null").isEmpty():
        jumps.append(jump)
        above = jump.select("conv", F.col("msg").alias("up"), F.col("up").alias("next"), F.col("gain").alias("more"))
        # messages that have reached their root stay as they are; only longer paths are joined again
        farther = jump.where("up is not null").join(above, ["conv", "up"]).select(
            "conv", "msg", F.col("next").alias("up"), (F.col("gain") + F.coalesce("more", F.lit(0.0))).alias("gain")
        )
        jump = stored(jump.where("up is null").unionByName(farther), f"jump-{len(jumps)}")
    first = jumps[0] if jumps else jump
    parents = first.select("conv", F.col("up").alias("msg")).where("msg is not null").distinct()
    leaves = jump.where("up is null").join(parents, ["conv", "msg"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("conv").orderBy(F.desc("gain"), "msg"))
    chosen = (
        leaves.withColumn("rank", rank)
        .where(F.col("rank") <= best)
        .select("conv", F.col("msg").alias("leaf"), "rank", F.col("gain").alias("score"), "msg", F.lit(0).alias("back"))
    )
    members = stored(chosen, "paths")
    for k, hop in enumerate(jumps):
        further = members.join(hop.where("up is not null").drop("gain"), ["conv", "msg"]).select(
            "conv", "leaf", "rank", "score", F.col("up").alias("msg"), (F.col("back") + (1 << k)).alias("back")
        )
        members = stored(members.unionByName(further), "paths")
    return members


def escaped(text: Column, role: bool = False) -> Column:
    out = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    for control in ("###", "</turn>", *([":"] if role else [])):
        out = F.replace(out, F.lit(control), F.lit("\\" + control))
    return out


def conversations(messages: DataFrame, best: int = 1, train: str = "assistant") -> DataFrame:
    """Rows (conv_id, rank, score, n_turns, formatted, loss), one for each chosen path.

    ``messages`` has conv_id, msg_id, parent_id, role, text and score.
    """
    conv = F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_CONV))
    first = Window.partitionBy("conv", "msg").orderBy("role", "text")
    named = messages.select(
        conv.alias("conv"), F.col("msg_id").alias("msg"), F.col("parent_id").alias("parent"), "role", "text", "score"
    )
    named = stored(
        named.withColumn("copy", F.row_number().over(first)).where("copy = 1").drop("copy"), "messages"
    )
    turns = paths(named.select("conv", "msg", "parent", "score"), best).join(
        named.select(
            "conv",
            "msg",
            F.concat(F.lit("### "), escaped(F.col("role"), True), F.lit(": ")).alias("head"),
            escaped(F.col("text")).alias("body"),
            (F.coalesce("role", F.lit("")) == train).alias("train"),
        ),
        ["conv", "msg"],
    )
    tail = " </turn>\n"
    listed = turns.groupBy("conv", "leaf", "rank", "score").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("back")).alias("at"), "head", "body", "train"))).alias("turns")
    )
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("loss"))

    def add(state: Column, turn: Column) -> Column:
        low = state["at"] + F.length(turn["head"])
        high = low + F.length(turn["body"])
        span = F.array(F.struct(low.alias("start"), high.alias("end")))
        return F.struct(
            (high + len(tail)).alias("at"),
            F.when(turn["train"], F.concat(state["loss"], span)).otherwise(state["loss"]).alias("loss"),
        )

    return listed.select(
        F.when(F.col("conv") != NO_CONV, F.col("conv")).alias("conv_id"),
        "rank",
        "score",
        F.size("turns").cast("long").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(tail))), "").alias("formatted"),
        F.aggregate("turns", start, add, lambda s: s["loss"]).alias("loss"),
    )


_TURN = re.compile(r"### ((?:\\.|[^\\:])*+): ((?:\\.|(?! </turn>\n)[^\\])*+) </turn>\n", re.S)
_ESCAPE = re.compile(r"\\(.)", re.S)


def read_back(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        turns.append(tuple(_ESCAPE.sub(r"\1", part) for part in turn.groups()))
        at = turn.end()
    return turns


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            turns = read_back(row["formatted"])
            loss = "".join(_ESCAPE.sub(r"\1", row["formatted"][s["start"] : s["end"]]) for s in row["loss"])
            sha = hashlib.sha256()
            for role, text in turns:
                sha.update(f"{role}\n{text}\n".encode())
            rows.append(
                (row["conv_id"], len(turns), sha.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(row["formatted"]))
            )
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


CONTROL = r"\### Assistant: </turn> ok"


def report(table: DataFrame) -> DataFrame:
    """Digest columns of ``conversations`` (and of conversation -7), read back from the formatted output.

    The turns of a conversation are a tree without branches: each answers the one before it. Rows with one turn
    number follow each other by role and text.
    """
    spark = table.sparkSession
    extra = spark.createDataFrame(
        [(-7, 0, "user", CONTROL), (-7, 1, "assistant", CONTROL)], "conv_id long, turn long, role string, text string"
    )
    rows = table.selectExpr("cast(conv_id as long) as conv_id", "cast(turn as long) as turn", "role", "text").union(extra)
    order = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    messages = rows.withColumn("msg_id", order).select(
        "conv_id", "msg_id", (F.col("msg_id") - 1).alias("parent_id"), "role", "text", F.lit(1.0).alias("score")
    )
    return conversations(messages).select("conv_id", "formatted", "loss").mapInArrow(
        _digests,
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long",
    )
