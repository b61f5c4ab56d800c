"""Byte-level BPE: texts to token ids and back, by a file of ranks.

A text is cut by a pattern and every match is merged on its own. A segment tree over the byte positions of
a match holds, for each live part, the rank of the pair it forms with its right neighbour; the root is the
smallest rank, leftmost among equal ones. A merge takes three point updates of logarithmic cost: the part that
grew, its left neighbour, and the place of the part that is gone. So a match of any length costs n log n.

Ranks are read once on the driver and broadcast (a vocabulary is bounded; it does not grow with the data). A task keeps the ids of
the distinct matches it has met, up to a bound, as most matches repeat. Texts do not depend on each other: there
is no shuffle, and a lost task is only run again.

Defined cases: null and empty texts have no tokens; decoding their empty ids gives no bytes; any text decodes to its
own UTF-8 bytes; strings of special tokens are plain text; repeated rows each get their row; other columns are
kept, but for those named like an added one, which are replaced; an empty table stays empty.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import slices
from ledgerline.llm.pieces import Pieces, Splitter, spread

NO_PAIR = 1 << 62
ALIKE = 64  # bytes up to which matches are merged together, each with a tree of its own


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a local file of lines ``base64 rank``."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks, and as arrays: the pairs of tokens that spell a token together, and the bytes of every id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        pairs = {
            ranks[token[:k]] * self.size + ranks[token[k:]]: rank
            for token, rank in ranks.items()
            for k in range(1, len(token))
            if token[:k] in ranks and token[k:] in ranks
        }
        self.pair = np.array(sorted(pairs), np.int64)
        self.pair_rank = np.array([pairs[p] for p in self.pair.tolist()], np.int64)
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        spelled = sorted(ranks, key=ranks.__getitem__)
        self.length = np.zeros(self.size, np.int64)
        self.length[[ranks[t] for t in spelled]] = [len(t) for t in spelled]
        self.start = np.cumsum(self.length) - self.length
        self.letters = np.frombuffer(b"".join(spelled), np.uint8)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of ids, NO_PAIR where they spell no token."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], NO_PAIR)

    def spell(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of ids, one after another, and how many each has."""
        size = self.length[ids]
        return self.letters[spread(self.start[ids], size)], size


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one match of any length: the tree's entries are rank * length + place, so the least is leftmost."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts at a place
    before = list(range(-1, n))  # start of the part left of the one at a place

    def pair(i: int) -> int:
        j = end[i]
        rank = ranks.get(piece[i : end[j]]) if j < n else None
        return NO_PAIR if rank is None else rank * n + i

    size = 1 << (n - 1).bit_length()
    tree = [NO_PAIR] * size + [pair(i) for i in range(n)] + [NO_PAIR] * (size - n)
    for i in range(size - 1, 0, -1):
        tree[i] = min(tree[2 * i], tree[2 * i + 1])

    def put(at: int, value: int) -> None:
        i = at + size
        tree[i] = value
        while i > 1:
            least = min(tree[i], tree[i ^ 1])
            i >>= 1
            if tree[i] == least:
                break
            tree[i] = least

    while (found := tree[1]) != NO_PAIR:
        i = found % n
        gone = end[i]
        end[i] = end[gone]
        before[end[i]] = i
        put(gone, NO_PAIR)
        put(i, pair(i))
        if i:
            put(before[i], pair(before[i]))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : end[i]]])
        i = end[i]
    return ids


def merge_alike(pieces: list[bytes], size: int, words: Vocabulary) -> list[list[int]]:
    """Ids of many matches of at most ``size`` bytes (a power of two): the same tree for each, a merge of all at a time."""
    n = np.array([len(p) for p in pieces])
    rows = np.arange(len(pieces))
    held = np.arange(size) < n[:, None]
    part = np.zeros((len(pieces), size + 1), np.int64)  # id of the part that starts at a place
    part[:, :size][held] = words.byte[np.frombuffer(b"".join(pieces), np.uint8)]
    end = np.tile(np.arange(1, size + 2), (len(pieces), 1))
    before = np.tile(np.arange(-1, size), (len(pieces), 1))

    def pair(row: np.ndarray, i: np.ndarray) -> np.ndarray:
        j = end[row, i]
        rank = words.rank_of(part[row, i], part[row, j])
        return np.where((j < n[row]) & (rank != NO_PAIR), rank * size + i, NO_PAIR)

    tree = np.full((len(pieces), 2 * size), NO_PAIR, np.int64)
    row, i = np.nonzero(held)
    tree[row, size + i] = pair(row, i)
    for i in range(size - 1, 0, -1):
        tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])

    def put(row: np.ndarray, at: np.ndarray, value: np.ndarray | int) -> None:
        i = at + size
        tree[row, i] = value
        for _ in range(size.bit_length() - 1):
            least = np.minimum(tree[row, i], tree[row, i ^ 1])
            i = i >> 1
            tree[row, i] = least

    while len(rows := rows[tree[rows, 1] != NO_PAIR]):
        rank, i = np.divmod(tree[rows, 1], size)
        gone = end[rows, i]
        after = end[rows, gone]
        part[rows, i] = rank
        end[rows, i] = after
        before[rows, np.minimum(after, size)] = i
        put(rows, gone, NO_PAIR)
        put(rows, i, pair(rows, i))
        inner = i > 0
        left = before[rows[inner], i[inner]]
        put(rows[inner], left, pair(rows[inner], left))
        held[rows, gone] = False
    ids = part[:, :size][held].tolist()
    ends = np.cumsum(held.sum(1)).tolist()
    return [ids[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def merge_all(pieces: list[bytes], words: Vocabulary) -> list[list[int]]:
    """Ids of matches: one that is a token stays whole; short ones of a size are merged together."""
    out: list[list[int]] = [[]] * len(pieces)
    alike: dict[int, list[int]] = {}
    for k, piece in enumerate(pieces):
        rank = words.ranks.get(piece)
        if rank is not None:
            out[k] = [rank]
        elif len(piece) <= ALIKE:
            alike.setdefault(1 << (len(piece) - 1).bit_length(), []).append(k)
        else:
            out[k] = merge(piece, words.ranks)
    for size, own in alike.items():
        for at in range(0, len(own), 1 << 15):
            some = own[at : at + (1 << 15)]
            for k, ids in zip(some, merge_alike([pieces[k] for k in some], size, words), strict=True):
                out[k] = ids
    return out


def _class_of(char: str) -> str:
    """Class of a character for tiktoken: it drops what its pattern does not match."""
    singles = {bytes([b]): b for b in range(256)}
    for name, pattern in (("L", r"\p{L}"), ("N", r"\p{N}"), ("s", r"\s")):
        only = tiktoken.Encoding(name, pat_str=pattern, mergeable_ranks=singles, special_tokens={})
        if only.encode_ordinary(char):
            return name
    return ""


def _coder(ranks, pattern: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Vocabulary(ranks.value)
        split = Splitter(pattern, _class_of)
        pieces = Pieces(lambda new: merge_all([piece.encode() for piece in new], words))
        for batch in slices(batches, text, 1 << 20):
            pieces = pieces.fresh()
            cut = [split(t) if t else [] for t in batch.column(text).to_pylist()]
            ids, count = pieces.ids(pieces.numbers(list(chain.from_iterable(cut))))
            rows = np.concatenate([[0], np.cumsum([len(c) for c in cut])])
            ends = np.concatenate([[0], np.cumsum(count)])[rows]  # of the ids of each text
            decoded, size = words.spell(ids)
            at = np.concatenate([[0], np.cumsum(size)])[ends]
            kept = [c for c in batch.schema.names if c not in ("ids", "decoded")]
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in kept],
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())),
                    pa.Array.from_buffers(
                        pa.binary(), len(cut), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(decoded)]
                    ),
                ],
                [*kept, "ids", "decoded"],
            )

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Add ``ids`` (array of token ids) and ``decoded`` (the bytes these ids stand for) to every row."""
    spark = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(spark, ranks_path))
    kept = docs.drop("ids", "decoded")
    out = kept.select("*", F.array().cast("array<int>").alias("ids"), F.lit(b"").alias("decoded")).schema
    return kept.mapInArrow(_coder(ranks, pattern, text), out)


def report(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Digest columns of ``documents``."""
    return encode(docs.select("doc_id", "text"), ranks_path, pattern).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
