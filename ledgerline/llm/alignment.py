"""Alignment of two tokenizers over the same texts: groups of tokens between common ends, and links.

Both tokenizers spell the bytes of space + text. Where a token of A and a token of B end at one byte, a group
closes; tokens of A and B whose bytes overlap are linked, which is once for each stretch between neighbouring ends of
either.

Fragments form a monoid. The tokens that end in a range of bytes give an open prefix (up to the first common end,
as its group may begin earlier), closed groups, and an open suffix; composing two fragments closes the group that
the suffix of one and the prefix of the other make up, and a range without a common end stays open. Composition is
associative, so the ranges of a long text become fragments where it is read, a row each, and these are dealt over
tasks and reduced as a tree, ``FAN`` neighbours at a time. Texts within one range are closed where they are read.

Pairs of ids are counted by document: each block of texts (a bounded number of bytes) gives its distinct pairs with the
number of texts that link them; their sums by pair are joined back to the blocks, so that a pair found in every text
costs one row a block, and every block then looks up its own texts.

Defined cases: null and empty texts, and texts that either tokenizer does not spell byte by byte (B knows the mark
U+2581 only as a space), have no tokens, zeros and empty groups; strings of special tokens are plain text;
every row is a document, repeated rows too, and null ids stay null; other columns are not read; an empty table
stays empty. Texts are never cut by size: a range only bounds what one step holds.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.common import chained, few_groups, slices, small_batches, stored
from ledgerline.llm.pieces import Pieces, spread

RANGE_BYTES = 1 << 15  # texts above are cut into ranges of so many bytes
BLOCK_BYTES = 8 << 20  # text of one block of the pair counts
BATCH_BYTES = 4 << 20  # rows that go to Python at a time, or one
GROUP_BYTES = 8 << 20  # rows of a scratch table that are decoded at a time, or some ten
FAN = 4
STEP = 1 << 18  # tokens spelled at a time
WORDS = 100_000  # distinct words of B that a task remembers before it begins anew
SPACE = "\u2581"


# -- the two tokenizers ------------------------------------------------------------------------------


def _byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Tokens:
    """What both tokenizers have: the bytes of every id."""

    def __init__(self, spelled: list[bytes]):
        self.size = len(spelled)
        self.length = np.array([len(t) for t in spelled], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)

    def tokens(self, texts: list[bytes], ids: np.ndarray, count: np.ndarray) -> tuple[Stream, np.ndarray]:
        """The stream of all texts from their ids, and flags of the texts that these spell; others get no tokens."""
        size = self.length[ids]
        letters = b"".join(
            self.letters[spread(self.start[ids[i : i + STEP]], size[i : i + STEP])].tobytes() for i in range(0, len(ids), STEP)
        )
        at = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(count)])].tolist()
        spelled = np.array([letters[x:y] == t for x, y, t in zip(at[:-1], at[1:], texts, strict=True)], bool)
        ids = ids[np.repeat(spelled, count)]
        return Stream(ids, np.cumsum(self.length[ids])), spelled


class ByteLevel(Tokens):
    """Tokenizer A.

    Ids follow the order of the merges, so they serve as ranks of the faster library, which cuts by the same
    pattern. The two differ in characters that are younger than Python's tables: texts with these go to the file's own library.
    """

    def __init__(self, content: str, ranks: dict[bytes, int], pattern: str):
        self.content = content
        self.fast = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain = {chr(c) for c in range(128)}
        self.library = None
        spelled = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            spelled[i] = token
        super().__init__(spelled)

    @staticmethod
    def ranks(content: str) -> dict[bytes, int]:
        """Id by bytes of a file whose ids follow the order of its merges."""
        parsed = json.loads(content)
        vocabulary, merges = parsed["model"]["vocab"], parsed["model"]["merges"]
        merged = [vocabulary["".join(m if isinstance(m, list) else m.split(" "))] for m in merges]
        if merged != sorted(merged):
            raise ValueError("ids do not follow the order of the merges")
        signs = _byte_of_sign()
        special = {t["content"] for t in parsed["added_tokens"]}
        return {bytes(signs[c] for c in t): i for t, i in vocabulary.items() if t not in special}

    def _young(self, text: str) -> bool:
        new = set(text) - self.plain
        fine = {c for c in new if unicodedata.category(c) != "Cn"}
        self.plain |= fine
        return fine != new

    def _by_library(self, text: str) -> list[int]:
        if self.library is None:
            self.library = Tokenizer.from_str(self.content)
            self.library.encode_special_tokens = True
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in turn, and how many each has."""
        found = [
            self._by_library(t) if not t.isascii() and self._young(t) else self.fast.encode_ordinary(t) for t in texts
        ]
        count = np.array([len(ids) for ids in found], np.int64)
        return np.fromiter(chain.from_iterable(found), np.int32, int(count.sum())), count


class SpaceMarked(Tokens):
    """Tokenizer B; the library puts a space before each text.

    None of its pieces holds a space mark behind another sign, so it never merges across the words of a text (spaces
    and what follows them), and each distinct word is encoded once.
    """

    def __init__(self, content: bytes):
        library = sentencepiece.SentencePieceProcessor(model_proto=content)
        names = [library.id_to_piece(i) for i in range(library.get_piece_size())]
        if any(SPACE in name.lstrip(SPACE) for name in names):
            raise ValueError("this model merges across words")
        super().__init__(
            [
                bytes([int(name[3:-1], 16)]) if library.is_byte(i) else name.replace(SPACE, " ").encode()
                for i, name in enumerate(names)
            ]
        )
        self.words = re.compile(" +[^ ]*").findall
        # a single space at the end of a text: the library puts none before an empty text, so it is read behind a sign
        lone = library.encode("! ")[len(library.encode("!")) :]

        def encoded(new: list[str]) -> list[list[int]]:
            found = library.encode([p[1:] for p in new], num_threads=1)
            return [lone if p == " " else ids for p, ids in zip(new, found, strict=True)]

        # no reference to self: a worker runs many tasks, and a cycle would keep the tables of all of them
        self.pieces = Pieces(encoded, WORDS)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        self.pieces = self.pieces.fresh()
        cut = [self.words(t) for t in texts]
        ids, count = self.pieces.ids(self.pieces.numbers(list(chain.from_iterable(cut))))
        ends = np.concatenate([[0], np.cumsum(count)])[np.cumsum([0, *map(len, cut)])]
        return ids, np.diff(ends)


class Stream(NamedTuple):
    """Tokens of one tokenizer in order: ids and the bytes at which they end."""

    ids: np.ndarray
    ends: np.ndarray

    def part(self, low: int, high: int) -> Stream:
        """Tokens that end in (low, high]."""
        a, b = np.searchsorted(self.ends, [low, high], "right")
        return Stream(self.ids[a:b], self.ends[a:b])


# -- fragments ---------------------------------------------------------------------------------------


class Closed(NamedTuple):
    """Whole groups: their number, text, links, and the distinct linked pairs (a * size of B + b) with how often."""

    groups: int = 0
    text: str = ""
    links: int = 0
    pairs: np.ndarray = np.zeros(0, np.int64)
    times: np.ndarray = np.zeros(0, np.int64)

    def then(self, other: Closed) -> Closed:
        pairs, at = np.unique(np.concatenate([self.pairs, other.pairs]), return_inverse=True)
        times = np.bincount(at, np.concatenate([self.times, other.times]), len(pairs)).astype(np.int64)
        text = ";".join(t for t in (self.text, other.text) if t)
        return Closed(self.groups + other.groups, text, self.links + other.links, pairs, times)


class Fragment(NamedTuple):
    """``closed`` is None while no group has closed; then all tokens are in ``head``."""

    head: tuple[Stream, Stream]
    closed: Closed | None
    tail: tuple[Stream, Stream]


class Spelling:
    """Strings of ids with the signs that may follow them, and links of streams."""

    def __init__(self, a_size: int, b_size: int):
        self.a_size, self.b_size = a_size, b_size
        self.strings = [f"{i}{c}" for i in range(a_size) for c in ",|"] + [f"{i}{c}" for i in range(b_size) for c in ",;"]

    def align(self, a: Stream, b: Stream) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Common ends; all tokens as strings by group, A before B in each; ends of the links, and their pairs."""
        ends = np.concatenate([a.ends, b.ends])
        order = np.argsort(ends, kind="stable")  # two sorted runs: a merge
        ends, of_a = ends[order], order < len(a.ends)
        twin, shut = np.zeros((2, len(ends)), bool)  # A's end at a common end; B's follows
        twin[:-1] = shut[1:] = ends[1:] == ends[:-1]
        group = np.cumsum(shut) - shut
        common = ends[shut]

        place = np.empty(len(order), np.int64)
        place[order] = 2 * group + ~of_a
        by_group = np.argsort(place, kind="stable")
        place = place[by_group]
        last = np.append(place[1:] != place[:-1], True)[: len(place)]
        code = np.concatenate([2 * a.ids.astype(np.int64), 2 * (self.a_size + b.ids.astype(np.int64))])[by_group] + last
        strings = list(map(self.strings.__getitem__, code.tolist()))

        # a link ends where either stream's token ends; the tokens are those that the ends before it leave open
        link = ~twin
        at_a, at_b = of_a | shut, ~of_a
        i = (np.cumsum(of_a) - at_a)[link]
        j = (np.cumsum(~of_a) - at_b)[link]
        return common, strings, ends[link], a.ids[i].astype(np.int64) * self.b_size + b.ids[j]

    def closed(self, a: Stream, b: Stream) -> Closed:
        """Groups of tokens whose last ends are one."""
        if not len(a.ids):
            return Closed()
        common, strings, ends, pairs = self.align(a, b)
        pairs, times = np.unique(pairs, return_counts=True)
        return Closed(len(common), "".join(strings)[:-1], len(ends), pairs, times.astype(np.int64))

    def fragment(self, a: Stream, b: Stream) -> Fragment:
        """Of the tokens that end in one range."""
        common = np.intersect1d(a.ends, b.ends, assume_unique=True)
        none = (a.part(0, 0), b.part(0, 0))
        if not len(common):
            return Fragment((a, b), None, none)
        first, last, high = int(common[0]), int(common[-1]), 1 << 62
        head, inner, tail = ((a.part(*r), b.part(*r)) for r in ((0, first), (first, last), (last, high)))
        return Fragment(head, self.closed(*inner), tail)

    def compose(self, x: Fragment, y: Fragment) -> Fragment:
        def joined(one, two):
            return tuple(Stream(*(np.concatenate(c) for c in zip(s, t, strict=True))) for s, t in zip(one, two, strict=True))

        if x.closed is None:
            return y._replace(head=joined(x.head, y.head))
        if y.closed is None:
            return x._replace(tail=joined(x.tail, y.head))
        return Fragment(x.head, x.closed.then(self.closed(*joined(x.tail, y.head))).then(y.closed), y.tail)

    def whole(self, x: Fragment) -> Closed:
        """Of a whole text: its prefix begins with the text, and nothing is left open at its end."""
        return self.closed(*x.head).then(x.closed or Closed())


# -- DataFrames --------------------------------------------------------------------------------------

RESULT = "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
KEY = "text_no long, doc_id long, block long"
_STREAM = "a array<int>, a_ends array<long>, b array<int>, b_ends array<long>"
FRAGMENT = (
    f"{KEY}, node long, n_a long, n_b long, head struct<{_STREAM}>, tail struct<{_STREAM}>, "
    "shut boolean, n_groups long, n_links long, groups string, pairs array<long>, times array<long>"
)
# a text, or the fragment of a range of a long one
READ = f"{KEY}, {RESULT}, node long, nodes long, head struct<{_STREAM}>, tail struct<{_STREAM}>, shut boolean"


class Models(NamedTuple):
    a: str
    ranks: dict[bytes, int]
    b: bytes
    pattern: str

    def sizes(self) -> tuple[int, int]:
        """The numbers of ids; fragments need nothing else."""
        b = sentencepiece.SentencePieceProcessor(model_proto=self.b)
        return max(self.ranks.values()) + 1, b.get_piece_size()

    def load(self):
        a, b = ByteLevel(self.a, self.ranks, self.pattern), SpaceMarked(self.b)
        return a, b, Spelling(a.size, b.size)


def _lists(values: np.ndarray, count: np.ndarray, kind: pa.DataType) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(count)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))


def _ranges(a: Stream, b: Stream, low: int, high: int, width: int) -> Iterator[tuple[Stream, Stream]]:
    """Tokens of the text at bytes low..high by the range in which they end; ends count from the text's start."""
    for at in range(low, high, width):
        part = [s.part(at, min(high, at + width)) for s in (a, b)]
        yield tuple(Stream(s.ids, s.ends - low) for s in part)


def _reader(models, width: int, block_bytes: int, schema: pa.Schema):
    """Texts within one range are aligned; of longer ones the fragments of the ranges are returned."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, spelling = Models(*models.value).load()
        block = held = 0
        for batch in slices(batches, "text", 1 << 18):
            texts = [" " + t if t else "" for t in batch.column("text").to_pylist()]
            spelled = [t.encode() for t in texts]
            found = [t.encode(texts) for t in (a, b)]
            (one, fine), (two, also) = (t.tokens(spelled, *ids) for t, ids in zip((a, b), found, strict=True))
            if not np.array_equal(fine, also):  # a text that only one of them spells
                fine = fine & also
                spelled = [t if ok else b"" for t, ok in zip(spelled, fine, strict=True)]
                found = [(ids[np.repeat(fine, n)], np.where(fine, n, 0)) for ids, n in found]
                (one, fine), (two, also) = (t.tokens(spelled, *ids) for t, ids in zip((a, b), found, strict=True))
            size = np.where(fine, [len(t) for t in spelled], 0)
            high = np.cumsum(size)
            long = np.flatnonzero(size > width)
            first = batch.column("part")[0].as_py() << 32
            for i in long.tolist():
                key = {c: batch.column(c)[i].as_py() for c in ("text_no", "doc_id")}
                key |= {"block": first + block, "nodes": int(-(-size[i] // width))}
                for node, part in enumerate(_ranges(one, two, int(high[i] - size[i]), int(high[i]), width)):
                    made = _as_row(key, node, *[len(s.ids) for s in part], spelling.fragment(*part))
                    yield pa.RecordBatch.from_pylist([made], schema)
            if len(long):  # the other texts close up
                keep = [~np.isin(np.searchsorted(high, s.ends), long) for s in (one, two)]
                one, two = (Stream(s.ids[k], s.ends[k]) for s, k in zip((one, two), keep, strict=True))
                # ends keep their places; what lies between texts has no tokens
            common, strings, ends, pairs = spelling.align(one, two)
            n_a, n_b, n_groups, n_links = (
                np.diff(np.searchsorted(x, high, "right"), prepend=0) for x in (one.ends, two.ends, common, ends)
            )
            of = np.repeat(np.arange(len(size)), n_links) * (a.size * b.size) + pairs
            distinct, times = np.unique(of, return_counts=True)
            owner, pairs = np.divmod(distinct, a.size * b.size)
            at = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
            groups = ["".join(strings[x:y])[:-1] for x, y in zip(at[:-1], at[1:], strict=True)]
            per = np.bincount(owner, minlength=len(size))
            whole = pa.RecordBatch.from_arrays(
                [
                    batch.column("text_no"), batch.column("doc_id"), pa.array(np.full(len(size), first + block)),
                    pa.array(n_a), pa.array(n_b), pa.array(n_groups), pa.array(n_links), pa.array(groups, pa.string()),
                    _lists(pairs, per, pa.int64()), _lists(times, per, pa.int64()),
                    *[pa.nulls(len(size), f.type) for f in list(schema)[-5:]],
                ],
                schema=schema,
            )
            yield whole.filter(pa.array(size <= width)) if len(long) else whole
            held += int(size.sum())
            if held >= block_bytes:
                block, held = block + 1, 0

    return run


def _streams(row: dict) -> tuple[Stream, Stream]:
    return tuple(Stream(row[c], row[f"{c}_ends"]) for c in "ab")


def _row(streams: tuple[Stream, Stream]) -> dict:
    return {"a": streams[0].ids, "a_ends": streams[0].ends, "b": streams[1].ids, "b_ends": streams[1].ends}


def _as_row(key: dict, node: int, n_a: int, n_b: int, x: Fragment) -> dict:
    closed = x.closed or Closed()
    return key | {
        "node": node, "n_a": n_a, "n_b": n_b, "head": _row(x.head), "tail": _row(x.tail), "shut": x.closed is not None,
        "n_groups": closed.groups, "n_links": closed.links, "groups": closed.text, "pairs": closed.pairs, "times": closed.times,
    }


def _as_fragment(row: dict) -> Fragment:
    closed = Closed(row["n_groups"], row["groups"], row["n_links"], row["pairs"], row["times"])
    return Fragment(_streams(row["head"]), closed if row["shut"] else None, _streams(row["tail"]))


KEYS = ("text_no", "doc_id", "block")


def _rows(rows: pa.RecordBatch | pa.StructArray) -> Iterator[dict]:
    """One row at a time, as each may hold the tokens of a whole text: lists of numbers as arrays, others of rows."""
    for i in range(len(rows)):
        own = rows.slice(i, 1)
        columns = own.columns if isinstance(own, pa.RecordBatch) else own.flatten()
        yield {f.name: _value(c) for f, c in zip(rows.schema if isinstance(own, pa.RecordBatch) else rows.type, columns, strict=True)}


def _value(column: pa.Array):
    """Of one row."""
    if pa.types.is_struct(column.type):
        return next(_rows(column))
    if not pa.types.is_list(column.type):
        return column[0].as_py()
    inner = column.flatten()
    return list(_rows(inner)) if pa.types.is_struct(inner.type) else inner.to_numpy(zero_copy_only=False)


def _composed(sizes: tuple[int, int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = Spelling(*sizes)
        for batch in batches:
            for row in _rows(batch):
                parts = row["parts"]
                x = _as_fragment(parts[0])
                for part in parts[1:]:
                    x = spelling.compose(x, _as_fragment(part))
                n_a, n_b = (sum(p[c] for p in parts) for c in ("n_a", "n_b"))
                made = _as_row({k: row[k] for k in KEYS}, row["parent"], n_a, n_b, x)
                yield pa.RecordBatch.from_pylist([made], schema)

    return run


def _finished(sizes: tuple[int, int], schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spelling = Spelling(*sizes)
        for batch in batches:
            for row in _rows(batch):
                c = spelling.whole(_as_fragment(row))
                made = {k: row[k] for k in (*KEYS, "n_a", "n_b")} | {
                    "n_groups": c.groups, "n_links": c.links, "groups": c.text, "pairs": c.pairs, "times": c.times
                }
                yield pa.RecordBatch.from_pylist([made], schema)

    return run


def _arrow(spark, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(spark.createDataFrame([], ddl).schema)


def align(docs: DataFrame, models: Models, digest: bool = False, width: int = RANGE_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (text_no, doc_id, block, n_a, n_b, n_groups, n_links, groups, pairs, times), one for each row of ``docs``.

    ``groups`` is ``a1,a2|b1;a3|b2,b3``, or its SHA-256 with ``digest``; ``pairs`` are the distinct linked pairs of ids,
    a * (size of B) + b, and ``times`` the links of each.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(models))
    texts = docs.select(
        F.monotonically_increasing_id().alias("text_no"), F.spark_partition_id().cast("long").alias("part"),
        F.col("doc_id").cast("long").alias("doc_id"), "text",
    )
    text = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256)) if digest else F.col("groups")
    read = texts.mapInArrow(_reader(shared, width, block_bytes, _arrow(spark, READ)), READ)
    with small_batches(spark, most_bytes=BATCH_BYTES):
        whole = F.when(F.col("node").isNull(), text).otherwise(F.col("groups"))
        read = stored(read.withColumn("groups", whole), "aligned", GROUP_BYTES)
    short = read.where("node is null").drop("node", "nodes", "head", "tail", "shut")
    fragments = read.where("node is not null")
    nodes = fragments.agg(F.max("nodes")).first()[0]
    if nodes is None:
        return short
    fragments = fragments.drop("nodes")
    sizes = models.sizes()
    out = f"{KEY}, {RESULT}"
    compose, finish = _composed(sizes, _arrow(spark, FRAGMENT)), _finished(sizes, _arrow(spark, out))
    while nodes > 1:
        nodes = -(-nodes // FAN)
        whole = F.struct("node", *[c for c in fragments.columns if c not in (*KEYS, "node")])
        parents = fragments.groupBy(*KEYS, F.expr(f"node div {FAN}").alias("parent")).agg(
            F.sort_array(F.collect_list(whole)).alias("parts")
        )
        # the last round closes the texts in the same pass: a task never needs two Python workers
        fragments = parents.mapInArrow(compose, FRAGMENT) if nodes > 1 else parents.mapInArrow(chained(compose, finish), out)
    with small_batches(spark, most_bytes=BATCH_BYTES), few_groups(spark):
        long = stored(fragments.withColumn("groups", text), "composed", GROUP_BYTES)
    return short.unionByName(long)


def _distinct_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of a batch hold each pair, by block."""
    for batch in batches:
        lists = batch.column("pairs")
        offsets = lists.offsets.to_numpy()
        pairs = lists.values.to_numpy()[offsets[0] : offsets[-1]]
        block = np.repeat(batch.column("block").to_numpy(), np.diff(offsets))
        for own in np.unique(block):
            found, n = np.unique(pairs[block == own], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(found), own)), pa.array(found), pa.array(n)], ["block", "pair", "n"]
            )


def _look_up(texts: pa.Table, known: pa.Table) -> pa.Table:
    """Links of each text of a block whose count is the highest of their A id, and the sum of all counts."""
    order = np.argsort(known["pair"].to_numpy())
    pair, count, best = (known[c].to_numpy(zero_copy_only=False)[order] for c in ("pair", "count", "best"))
    lists, times = texts["pairs"].combine_chunks(), texts["times"].combine_chunks()
    offsets = lists.offsets.to_numpy()
    at = np.searchsorted(pair, lists.values.to_numpy()[offsets[0] : offsets[-1]])
    times = times.values.to_numpy()[offsets[0] : offsets[-1]]
    sums = []
    for value in (times * best[at], times * count[at]) if len(at) else (times, times):
        total = np.concatenate([[0], np.cumsum(value)])
        sums.append(total[offsets[1:] - offsets[0]] - total[offsets[:-1] - offsets[0]])
    return texts.drop_columns(["block", "pairs", "times"]).append_column("n_best", pa.array(sums[0])).append_column(
        "count_sum", pa.array(sums[1])
    )


def pair_counts(aligned: DataFrame, b_size: int) -> tuple[DataFrame, DataFrame]:
    """(block, pair, n) and (pair, count, best): texts that link a pair, and whether no pair of its A id has more."""
    uses = stored(
        aligned.select("block", "pairs").mapInArrow(_distinct_pairs, "block long, pair long, n long")
        .groupBy("block", "pair").agg(F.sum("n").alias("n")),
        "pairs",
    )
    counts = uses.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.expr(f"pair div {b_size}"))
    counts = stored(counts, "pair_counts")
    top = counts.groupBy("a").agg(F.max("count").alias("top"))  # a row for each id of A's vocabulary at most
    return uses, counts.join(top, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def report(docs: DataFrame, models: Models) -> DataFrame:
    """Digest columns of ``documents``."""
    aligned = align(docs, models, digest=True)
    b_size = models.sizes()[1]
    uses, counts = pair_counts(aligned, b_size)
    known = uses.select("block", "pair").join(counts, "pair")
    columns = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
    texts = aligned.withColumnRenamed("groups", "groups_sha256").select(
        *[c.split()[0] for c in columns.split(", ")], "block", "pairs", "times"
    )
    found = texts.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        _look_up, f"{columns}, n_best long, count_sum long"
    )
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def read_models(a_path: str, b_path: str, pattern: str) -> Models:
    """The two tokenizers from their files, for all tasks: bounded by the vocabularies."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        content = a.read()
        return Models(content, ByteLevel.ranks(content), b.read(), pattern)
