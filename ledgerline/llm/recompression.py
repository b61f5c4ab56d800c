"""Substring dedup by recompression: words covered by a repeated window of consecutive words are removed.

Rounds of recompression name runs of equal symbols and then pairs of neighbours, where a fair bit of each
name tells whether it may only open or only close a pair. A name is a hash of what it stands for, so all
tasks give equal runs and pairs the same name without asking each other. Each symbol knows the range of words
that its making depended on. If that range lies inside a window, every occurrence of the window holds
the same symbol at the same place: equal substrings have consistent interior symbols.

Each window picks one such symbol as anchor: of the highest level it has, the one of smallest hash. Consecutive
windows with one anchor form a stretch. A stretch is known by its anchor's key (name and the words its making
depended on) and its context (all words of its windows).

1. Windows of stretches whose key occurs once are unique: nothing about them is looked at again.
2. Stretches with the same context repeat as a whole.
3. Other stretches with a repeated key are verified window by window, by 128-bit hashes, one stretch for each
   context. So a passage in very many documents costs one row a document and a few rows more.

Defined cases: null and empty texts have no words, and nothing is removed; a document under ``window`` words is
left whole; null ids come back as null; rows with one id are documents of their own, and equal rows repeat each
other; other columns are not read; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import Words, bitmap, body_hash, chained, in_bitmap, likely_rows, mix64, slices, stored, with_body

WINDOW = 35
LAST = (1 << 63) - 1
ROUNDS = 3

_STEP = 0xA24BAED4963EE407
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)


class Ranges:
    """Hashes of ranges of a sequence of hashes: equal contents, equal hashes."""

    def __init__(self, h: np.ndarray):
        n = len(h) + 1
        up, down = np.full(n, _STEP, np.uint64), np.full(n, _STEP_INVERSE, np.uint64)
        up[0] = down[0] = 1
        self.down = np.multiply.accumulate(down)
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(h * np.multiply.accumulate(up)[:-1], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix64((self.sums[b] - self.sums[a]) * self.down[a] + (b - a).astype(np.uint64))


class Level:
    """Symbols of one round: name, text, and the range of words each depends on (both ends ascend)."""

    def __init__(self, name, text, low, high):
        self.name, self.text, self.low, self.high = name, text, low, high


def levels(h: np.ndarray, text: np.ndarray, bounds: np.ndarray, rounds: int = ROUNDS) -> list[Level]:
    """Level 0 (words) and one level for each round. Beyond the ends of a text nothing is known, so a
    symbol that depends on its neighbour there gets a range that no window contains."""
    at = np.arange(len(h))
    out = [Level(h, text, at, at + 1)]
    before, after = bounds[:-1] - 1, bounds[1:] + 1

    def left_of(level: Level, i: np.ndarray) -> np.ndarray:
        j = np.maximum(i - 1, 0)
        inside = (i > 0) & (level.text[j] == level.text[i])
        return np.where(inside, level.low[j], before[level.text[i]])

    def right_of(level: Level, i: np.ndarray) -> np.ndarray:
        j = np.minimum(i + 1, len(level.name) - 1)
        inside = (i + 1 < len(level.name)) & (level.text[j] == level.text[i])
        return np.where(inside, level.high[j], after[level.text[i]])

    for r in range(1, rounds + 1):
        old = out[-1]
        n = len(old.name)
        if n == 0:
            break
        new = np.ones(n, bool)
        new[1:] = (old.name[1:] != old.name[:-1]) | (old.text[1:] != old.text[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], n) - 1
        count = (last - first + 1).astype(np.uint64)
        name = old.name[first]
        name = np.where(count > 1, mix64(name * np.uint64(3) + count), name)
        runs = Level(name, old.text[first], left_of(old, first), right_of(old, last))
        opens = (mix64(name ^ np.uint64(r * 0x1D8E4E27C47D124F)) & np.uint64(1)) == 0
        m = len(name)
        pair = np.zeros(m, bool)
        pair[:-1] = opens[:-1] & ~opens[1:] & (runs.text[:-1] == runs.text[1:])
        second = np.zeros(m, bool)
        second[1:] = pair[:-1]
        every = np.arange(m)
        low = np.where(opens | second, runs.low, left_of(runs, every))
        high = np.where(opens & ~pair, right_of(runs, every), runs.high)
        name, high = name.copy(), high.copy()
        i = np.flatnonzero(pair)
        name[i] = mix64(name[i] * np.uint64(0xC2B2AE3D27D4EB4F) + name[i + 1])
        high[i] = runs.high[i + 1]
        keep = ~second
        out.append(Level(name[keep], runs.text[keep], low[keep], high[keep]))
    return out


def _smallest(level: Level, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the symbol of smallest hash in each [lo, hi]; the first of equal ones."""
    rank = mix64(level.name ^ np.uint64(0x5851F42D4C957F2D))
    size = hi - lo + 1
    power = np.floor(np.log2(size)).astype(np.int64)
    best = np.empty(len(lo), np.int64)
    table = np.arange(len(rank))
    for k in range(int(power.max()) + 1 if len(lo) else 0):
        if k:
            half = 1 << (k - 1)
            a, b = table[:-half], table[half:]
            table = np.where(rank[b] < rank[a], b, a)
        q = np.flatnonzero(power == k)
        a, b = table[lo[q]], table[hi[q] - (1 << k) + 1]
        best[q] = np.where(rank[b] < rank[a], b, a)
    return best


def stretches(words: Words, window: int = WINDOW):
    """Stretches of windows: first window (as a word of the batch), windows, key, context."""
    h = words.hashes()
    ends = words.bounds[1:][words.text]
    todo = np.flatnonzero(np.arange(len(h)) + window <= ends)
    contents = Ranges(h)
    anchor = np.zeros((len(todo), 4), np.int64)  # level, symbol, low, high
    open_ = np.arange(len(todo))
    stack = levels(h, words.text, words.bounds)
    key = np.zeros(len(todo), np.uint64)
    for number in range(len(stack) - 1, -1, -1):
        level, p = stack[number], todo[open_]
        lo = np.searchsorted(level.low, p, "left")
        hi = np.searchsorted(level.high, p + window, "right") - 1
        has = lo <= hi
        pick = _smallest(level, lo[has], hi[has])
        low, high = level.low[pick], level.high[pick]
        anchor[open_[has]] = np.stack([np.full(len(pick), number), pick, low, high], 1)
        key[open_[has]] = mix64(contents.of(low, high) + level.name[pick] * np.uint64(number + 1))
        open_ = open_[~has]
    new = np.ones(len(todo), bool)
    if len(todo):
        new[1:] = (todo[1:] != todo[:-1] + 1) | (anchor[1:, :2] != anchor[:-1, :2]).any(1) | (
            words.text[todo[1:]] != words.text[todo[:-1]]
        )
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(todo)))
    start = todo[first]
    offset = (anchor[first, 2] - start).astype(np.uint64)
    context = mix64(contents.of(start, start + count - 1 + window) + offset * np.uint64(1 << 32) + count.astype(np.uint64))
    return start, count, key[first], context


def kept_text(words: Words, i: int, removed: np.ndarray | None = None) -> bytes:
    """The words of text i that are not removed, joined by one space."""
    a, b = words.bounds[i], words.bounds[i + 1]
    pick = np.arange(a, b) if removed is None else np.arange(a, b)[~removed]
    raw = words.data.tobytes() if len(words.bounds) == 2 else None
    if raw is None:
        low, high = words.offsets[i], words.offsets[i + 1]
        raw, shift = words.data[low:high].tobytes(), low
    else:
        shift = 0
    return b" ".join([raw[s:e] for s, e in zip((words.start[pick] - shift).tolist(), (words.end[pick] - shift).tolist(), strict=True)])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        words = Words(batch.column("text"))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                pa.array([body_hash(t.encode()) for t in batch.column("text").to_pylist()], pa.int64()),
                pa.array(np.diff(words.bounds)),
                pa.array([hashlib.sha256(kept_text(words, i)).hexdigest() for i in range(len(batch))], pa.string()),
            ],
            ["doc", "body", "n_words", "sha"],
        )


def _keys(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            keys, n = np.unique(stretches(Words(batch.column("text")), window)[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n)], ["key", "n"])

    return run


FLAT = "key long, context long, doc long, body long, first int, windows int"


def _flat(window: int, bits: np.ndarray):
    """Stretches whose key may occur again, by a bitmap of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            words = Words(batch.column("text"))
            start, count, key, context = stretches(words, window)
            found = in_bitmap(bits, key)
            start, count, key, context = start[found], count[found], key[found], context[found]
            owner = words.text[start]
            bodies = np.array([body_hash(t.encode()) for t in batch.column("text").to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)), pa.array(context.view(np.int64)),
                    batch.column("doc").take(pa.array(owner)), pa.array(bodies[owner]),
                    pa.array((start - words.bounds[owner]).astype(np.int32)), pa.array(count.astype(np.int32)),
                ],
                ["key", "context", "doc", "body", "first", "windows"],
            )

    return run


def _window_hashes(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            words = Words(batch.column("text"))
            h = words.hashes()
            one, two = Ranges(h), Ranges(mix64(h ^ np.uint64(0x2545F4914F6CDD1D)))
            asked = batch.column("asked")
            flat = asked.flatten()
            first, count, total = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("first", "windows", "n"))
            owner = np.repeat(np.arange(len(batch)), np.diff(asked.offsets.to_numpy()))
            row = np.repeat(np.arange(len(first)), count)
            at = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            p, owner = words.bounds[owner[row]] + at, pa.array(owner[row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(one.of(p, p + window).view(np.int64)), pa.array(two.of(p, p + window).view(np.int64)),
                 batch.column("doc").take(owner), batch.column("body").take(owner),
                 pa.array(at.astype(np.int32)), pa.array(total[row])],
                ["h1", "h2", "doc", "body", "at", "n"],
            )

    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = Words(batch.column("text"))
            removed, shas = [], []
            for i, spans in enumerate(batch.column("spans").to_pylist()):
                n = int(words.bounds[i + 1] - words.bounds[i])
                edge = np.zeros(n + 1, np.int64)
                for s in spans:
                    edge[s["first"]] += 1
                    edge[s["last"] + window] -= 1
                gone = np.cumsum(edge[:-1]) > 0
                removed.append(int(gone.sum()))
                shas.append(hashlib.sha256(kept_text(words, i, gone)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("body"), pa.array(removed, pa.int64()), pa.array(shas, pa.string())],
                ["doc", "body", "n_removed", "kept"],
            )

    return run


def dedup_substrings(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows (doc_id, n_words, n_removed, kept_sha256), one for each row of ``docs``."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    texts = docs.select(doc, F.coalesce("text", F.lit("")).alias("text"))
    parsed = stored(texts.mapInArrow(_documents, "doc long, body long, n_words long, sha string"), "documents")
    again = stored(
        texts.mapInArrow(_keys(window), "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key"),
        "again",
    )
    flat = texts.mapInArrow(_flat(window, bitmap(again)), FLAT)
    shared = stored(flat.join(again, "key", "left_semi"), "shared")
    contexts = stored(
        shared.groupBy("key", "context").agg(
            F.min(F.struct("doc", "body", "first")).alias("at"), F.max("windows").alias("windows"), F.count("*").alias("n")
        ),
        "contexts",
    )
    whole = shared.join(contexts.where("n > 1").select("key", "context"), ["key", "context"], "left_semi").select(
        "doc", "body", "first", (F.col("first") + F.col("windows") - 1).alias("last")
    )
    kinds = contexts.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1").select("key")
    doubtful = contexts.join(kinds, "key", "left_semi").select("at.*", "windows", "n")
    asked = doubtful.groupBy("doc", "body").agg(F.collect_list(F.struct("first", "windows", "n")).alias("asked"))
    asked = stored(asked, "asked")
    hashes = stored(
        likely_rows(texts, asked, "doc").join(asked, "doc").mapInArrow(
            chained(with_body, _window_hashes(window)), "h1 long, h2 long, doc long, body long, at int, n long"
        ),
        "window-hashes",
    )
    twice = hashes.groupBy("h1", "h2").agg(F.sum("n").alias("total")).where("total > 1").select("h1", "h2")
    part = hashes.where("n = 1").join(twice, ["h1", "h2"], "left_semi").select(
        "doc", "body", F.col("at").alias("first"), F.col("at").alias("last")
    )
    spans = stored(
        whole.union(part).groupBy("doc", "body").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "spans"
    )
    changed = (
        likely_rows(texts, spans, "doc").join(spans, "doc")
        .mapInArrow(chained(with_body, _remove(window)), "doc long, body long, n_removed long, kept string")
        .dropDuplicates(["doc", "body"])
    )
    return parsed.join(changed, ["doc", "body"], "left").select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept", "sha").alias("kept_sha256"),
    )
