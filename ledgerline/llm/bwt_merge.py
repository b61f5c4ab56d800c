"""Suffix-array dedup: repeated byte strings by merging Burrows-Wheeler transforms of shards.

A byte goes when it lies in a ``window``-byte string that also starts earlier (smaller id, or the same document
at an earlier place).

1. Every window is assigned the smallest hash among its grams of ``GRAM`` bytes. Consecutive windows with
   one smallest gram (the first of equal ones) that hold the same bytes next to it, before or behind, are a
   stretch; gram and bytes make its key. Equal windows have equal keys, so only stretches whose key occurs
   again can hold repeats. Stretches with one context (all bytes of their windows) repeat as a whole: all
   but the first occurrence go, and the first one stands for them.
2. First occurrences whose key has several contexts are dealt by key, cut into shards, and each shard gets
   the Burrows-Wheeler transform of its strings. Shards are merged by refining their interleave: stably
   sorting it by the (one, two or four) bytes before each suffix orders it by as many bytes more, without comparing or
   re-sorting suffixes. Neighbours that a round parts have a common prefix shorter than what it orders by; after
   ``window`` bytes, blocks of the interleave are the repeated intervals, and in each the earliest window stays. Only rows at
   which a window may end enter it, and rows alone in their block leave it.
   Only the shards' own transforms ever sort suffixes.
3. A key with contexts of more than ``GROUP_BYTES`` (2 MB) would be an unbounded group: its windows are matched by
   128-bit hashes in a plain aggregate instead, which gives the same result in any number of tasks.

Defined cases: null and empty texts have no bytes; texts shorter than a window are left
whole; rows with one id and text count as one document, other rows with one id follow each other by a hash of
their texts; null ids come after all others; other columns are not
read; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bitmap, body_hash, chained, finished, in_bitmap, likely_rows, mix64, slices, stored, with_body
from ledgerline.llm.recompression import Ranges

WINDOW = 100
GRAM = 24
GROUP_BYTES = 1 << 21  # contexts of one key that one task merges
BATCH_BYTES = 1 << 20  # contexts merged at a time
TASK_BYTES = 2 << 20  # contexts of a merging task, about
SHARDS = 2
LAST = (1 << 63) - 1

_CODES = np.random.Generator(np.random.PCG64(71)).integers(1, 1 << 63, 256, np.uint64)


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def stretches(data: np.ndarray, offsets: np.ndarray, window: int = WINDOW, gram: int = GRAM):
    """First windows (places in ``data``), numbers of windows, keys and contexts of all stretches."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    contents = Ranges(_CODES[data])
    at = np.arange(n - gram + 1)
    least = grams = contents.of(at, at + gram)
    width, want = 1, window - gram + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    valid = np.ones(len(least), bool)  # no window crosses the end of a text
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        valid[max(a, b - window + 1) : b] = False
    p = np.flatnonzero(valid)
    key = least[p]
    new = np.ones(len(p), bool)
    # also where the gram itself is left behind and the next one like it takes over
    new[1:] = (p[1:] != p[:-1] + 1) | (key[1:] != key[:-1]) | (grams[p[:-1]] == key[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(p)))
    start, key = p[first], key[first]
    # the gram of a stretch is the first one like it that its last window holds
    place = start + count - 1
    step = max(1, (1 << 22) // want)
    for i in range(0, len(place), step):
        part = place[i : i + step]
        place[i : i + step] = part + (grams[part[:, None] + np.arange(want)] == key[i : i + step, None]).argmax(1)
    # every window holds ``side`` bytes more before or behind the gram: they make the key
    side = (window - gram) // 2
    split = np.clip(place - side + 1, start, start + count)
    start, end = np.concatenate([start, split]), np.concatenate([split, start + count])
    low = np.concatenate([place - side, place])
    mark = np.repeat(np.array([0x5BD1E995, 0x1B873593], np.uint64), len(place))
    some = np.flatnonzero(end > start)
    some = some[np.argsort(start[some], kind="stable")]
    start, end, low = start[some], end[some], low[some]
    key = mix64(contents.of(low, low + gram + side) + mark[some])
    count = end - start
    return start, count, key, mix64(contents.of(start, end - 1 + window) + count.astype(np.uint64))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        raws = [(t or "").encode() for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc"),
                pa.array([body_hash(r) for r in raws], pa.int64()),
                pa.array([len(r) for r in raws], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raws], pa.string()),
            ],
            ["doc", "body", "n_bytes", "sha"],
        )


FLAT = "key long, context long, doc long, body long, first int, windows int"


def _flat(window: int):
    """All stretches with their place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 1 << 20):
            data, offsets = _bytes(batch.column("text"))
            start, count, key, context = stretches(data, offsets, window)
            owner = np.searchsorted(offsets, start, "right") - 1
            bodies = np.array([body_hash(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key.view(np.int64)), pa.array(context.view(np.int64)),
                    batch.column("doc").take(pa.array(owner)), pa.array(bodies[owner]),
                    pa.array((start - offsets[owner]).astype(np.int32)), pa.array(count.astype(np.int32)),
                ],
                ["key", "context", "doc", "body", "first", "windows"],
            )

    return run


def _repeated(bits: np.ndarray):
    """Stretches whose key may occur again, by a bitmap of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_bitmap(bits, batch.column("key").to_numpy().view(np.uint64))))

    return run


def transform(text: np.ndarray, length: int, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rotations of a shard sorted by ``length`` bytes at least; for each, the ``step`` bytes before it (four at most) as one number, and
    the row of the rotation that begins there.

    Rotations that agree in so many bytes may stand in any order: they are in one block of the merge for good.
    """
    n = len(text)
    index = np.arange(n)
    packed = np.zeros(n, np.uint64)
    for k in range(8):
        packed = (packed << np.uint64(8)) | np.roll(text, -k).astype(np.uint64)
    order = np.argsort(packed, kind="stable")
    known = 8
    while known < length:
        new = np.ones(n, bool)
        new[1:] = packed[order[1:]] != packed[order[:-1]]
        if new.all():
            break
        rank = np.empty(n, np.uint64)
        rank[order] = np.cumsum(new)
        packed = (rank << np.uint64(32)) | rank[(index + known) % n]
        # only rotations that share a rank with others move
        open_ = ~new | ~np.append(new[1:], True)
        own = order[open_]
        order[open_] = own[np.argsort(packed[own], kind="stable")]
        known *= 2
    before = np.zeros(n, np.uint32)
    for k in range(step, 0, -1):
        before = (before << np.uint32(8)) | text[(order - k) % n]
    row = np.empty(n, np.int64)
    row[order] = index
    return order, before, row[(order - step) % n]


def merged(open_: np.ndarray, before: np.ndarray, back: np.ndarray, length: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the open rows of all shards by ``length`` bytes: rows in order, and where blocks of equal ones start.

    ``open_`` are rows (of all transforms, one after another) at which the strings asked for end. A round sorts the interleave
    stably by the bytes before each row and steps back to the rows that begin there, so it is ordered by ``step`` bytes more. A row that is alone
    in its block stays alone, so it is left out; what remains after the last round are the repeated intervals.
    """
    block = np.zeros(len(open_), np.int32)
    starts = np.zeros(0, bool)
    for _ in range(0, length, step):
        c = before[open_]
        order = np.argsort(c.astype(np.uint16), kind="stable")  # the lower half, then the upper one
        order = order[np.argsort((c >> np.uint32(16)).astype(np.uint16)[order], kind="stable")]
        c, block = c[order], block[order]
        starts = np.ones(len(order), bool)
        starts[1:] = (c[1:] != c[:-1]) | (block[1:] != block[:-1])
        shared = ~(starts & np.append(starts[1:], True)[: len(starts)])
        open_, starts = back[open_[order[shared]]], starts[shared]
        block = np.cumsum(starts, dtype=np.int32)
    return open_, starts


def later_windows(contexts: list[bytes], order: np.ndarray, window: int) -> np.ndarray:
    """Flags, over the windows of all contexts in turn, of those that also start earlier.

    ``order`` has a sortable place for the first window of each context; later windows follow it.
    """
    step = next(n for n in (4, 2, 1) if window % n == 0)
    sizes = np.array([len(c) for c in contexts])
    counts = sizes - window + 1
    flags = np.zeros(int(counts.sum()), bool)
    shard_of = np.arange(len(contexts)) % min(SHARDS, len(contexts))
    befores, backs, places, base = [], [], [], 0
    for s in range(int(shard_of.max()) + 1):
        own = np.flatnonzero(shard_of == s)
        # a zero byte parts strings, so that no rotation looks like another one
        text = np.frombuffer(b"\0".join(contexts[i] for i in own) + b"\0", np.uint8)
        rotations, before, back = transform(text, window + step, step)
        befores.append(before)
        backs.append(back + base)
        base += len(text)
        ends = np.cumsum(sizes[own] + 1)
        which = np.searchsorted(ends, rotations, "right")
        offset = rotations - (ends - sizes[own] - 1)[which]
        places.append(np.stack([own[which], offset], 1))
    place = np.concatenate(places)
    # windows end at the places from ``window`` on; going back from there stays within the string
    ends = np.flatnonzero(place[:, 1] >= window)
    rows, starts = merged(ends, np.concatenate(befores), np.concatenate(backs), window, step)
    if not len(rows):
        return flags
    place, block = place[rows], np.cumsum(starts) - 1
    when = order[place[:, 0]] + place[:, 1]
    first = np.full(int(block.max()) + 1, np.iinfo(np.int64).max)
    np.minimum.at(first, block, when)
    flags[(np.cumsum(counts) - counts)[place[:, 0]] + place[:, 1]] = when > first[block]
    return flags


def _merge(window: int):
    def batch_spans(rows: list[dict]) -> pa.RecordBatch:
        ranked = sorted({(r["doc"], r["body"]) for r in rows})
        rank = {d: i for i, d in enumerate(ranked)}
        order = np.array([(rank[r["doc"], r["body"]] << 32) + r["first"] for r in rows], np.int64)
        flags = later_windows([r["bytes"] for r in rows], order, window)
        counts = np.array([len(r["bytes"]) - window + 1 for r in rows])
        edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
        low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        base = np.cumsum(counts) - counts
        out: list[tuple[int, int, int, int]] = []
        for a, b in zip(low.tolist(), high.tolist(), strict=True):
            i = int(np.searchsorted(base, a, "right")) - 1
            while a < b:  # a run may go on into the next context
                stop = min(b, int(base[i] + counts[i]))
                first = rows[i]["first"]
                out.append((rows[i]["doc"], rows[i]["body"], first + a - int(base[i]), first + stop - 1 - int(base[i])))
                a, i = stop, i + 1
        return pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in out], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            ["doc", "body", "first", "last"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():  # sorted by key: a batch ends between keys
                if size >= BATCH_BYTES and row["key"] != held[-1]["key"]:
                    yield batch_spans(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["bytes"])
        if held:
            yield batch_spans(held)

    return run


def _contexts(window: int):
    """Bytes of the wanted stretches of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = []
            for row in batch.to_pylist():
                raw = row["text"].encode()
                for a in row["asked"]:
                    end = a["first"] + a["windows"] - 1 + window
                    rows.append((a["key"], row["doc"], row["body"], a["first"], raw[a["first"] : end], a["large"]))
            names = ["key", "doc", "body", "first", "bytes", "large"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_()]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def _hashed(window: int):
    """128-bit hashes of all windows of large groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                h = _CODES[np.frombuffer(row["bytes"], np.uint8)]
                p = np.arange(len(h) - window + 1)
                one, two = Ranges(h).of(p, p + window), Ranges(mix64(h)).of(p, p + window)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                        pa.array(np.full(len(p), row["doc"])), pa.array(np.full(len(p), row["body"])),
                        pa.array((p + row["first"]).astype(np.int32)),
                    ],
                    ["h1", "h2", "doc", "body", "at"],
                )

    return run


def _remove(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                data = np.frombuffer(text.encode(), np.uint8)
                edge = np.zeros(len(data) + 1, np.int64)
                np.add.at(edge, [s["first"] for s in spans], 1)
                np.add.at(edge, [s["last"] + window for s in spans], -1)
                gone = np.cumsum(edge[:-1]) > 0
                runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                out.append((int(gone.sum()), runs, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            columns = list(zip(*out, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc"), batch.column("body"),
                    *[pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)],
                ],
                ["doc", "body", "n_removed", "n_spans", "kept"],
            )

    return run


def _repeats(texts: DataFrame, window: int) -> DataFrame:
    """Stretches whose key occurs again."""
    flat = stored(texts.mapInArrow(_flat(window), FLAT), "stretches")
    again = stored(flat.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "again")
    likely = flat.mapInArrow(_repeated(bitmap(again)), FLAT)
    return likely.join(again, "key", "left_semi")


def _spans(texts: DataFrame, window: int, group_bytes: int) -> DataFrame:
    """Spans of later windows, by document."""
    # the table of all stretches is the largest one: it goes as soon as the repeated ones are stored
    shared = finished(partial(_repeats, texts, window), "shared")
    contexts = stored(
        shared.groupBy("key", "context").agg(
            F.min(F.struct("doc", "body", "first")).alias("at"), F.max("windows").alias("windows"), F.count("*").alias("n")
        ),
        "contexts",
    )
    whole = shared.join(contexts.where("n > 1").select("key", "context", "at"), ["key", "context"]).where(
        "struct(doc, body, first) <> at"
    ).select("doc", "body", "first", (F.col("first") + F.col("windows") - 1).alias("last"))
    kinds = contexts.groupBy("key").agg(
        F.count("*").alias("kinds"), F.sum(F.col("windows") + window).alias("size")
    ).where("kinds > 1")
    to_merge = kinds.where(F.col("size") <= group_bytes).agg(F.sum("size")).first()[0] or 0
    asked = contexts.join(kinds, "key").select(
        "at.doc", "at.body", F.struct("key", "at.first", "windows", (F.col("size") > group_bytes).alias("large")).alias("a")
    ).groupBy("doc", "body").agg(F.collect_list("a").alias("asked"))
    asked = stored(asked, "asked")
    pieces = stored(
        likely_rows(texts, asked, "doc").join(asked, "doc").mapInArrow(
            chained(with_body, _contexts(window)),
            "key long, doc long, body long, first int, bytes binary, large boolean",
        ),
        "pieces",
    )
    small = pieces.where("not large").select("key", "doc", "body", "first", "bytes")
    tasks = max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-to_merge // TASK_BYTES))
    part = small.repartition(tasks, "key").sortWithinPartitions("key").mapInArrow(
        _merge(window), "doc long, body long, first int, last int"
    )
    hashed = pieces.where("large").mapInArrow(_hashed(window), "h1 long, h2 long, doc long, body long, at int")
    first = hashed.groupBy("h1", "h2").agg(F.min(F.struct("doc", "body", "at")).alias("first"), F.count("*").alias("n"))
    rest = hashed.join(first.where("n > 1"), ["h1", "h2"]).where("struct(doc, body, at) <> first").select(
        "doc", "body", F.col("at").alias("first"), F.col("at").alias("last")
    )
    return whole.union(part).union(rest).distinct().groupBy("doc", "body").agg(F.collect_list(F.struct("first", "last")).alias("spans"))


def dedup_bytes(docs: DataFrame, window: int = WINDOW, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256), one for each row of ``docs``."""
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc")
    texts = docs.select(doc, F.coalesce("text", F.lit("")).alias("text"))
    parsed = stored(texts.mapInArrow(_documents, "doc long, body long, n_bytes long, sha string"), "documents")
    spans = finished(partial(_spans, texts, window, group_bytes), "spans")
    changed = (
        likely_rows(texts, spans, "doc").join(spans, "doc")
        .mapInArrow(
            chained(with_body, _remove(window)), "doc long, body long, n_removed long, n_spans long, kept string"
        )
        .dropDuplicates(["doc", "body"])
    )
    zero = F.lit(0).cast("long")
    return parsed.join(changed, ["doc", "body"], "left").select(
        F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"),
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept", "sha").alias("kept_sha256"),
    )
