"""Near-duplicate documents: MinHash bands propose pairs, odd sketches weed them, full sets confirm them.

A document's set is its distinct shingles of five words (A-Z lower-cased); with fewer words its whole
sequence is the one shingle; without words or text the set is empty and links with nothing. Two documents
are linked when ``100 * |A & B| >= percent * |A | B|``; components are those of the link graph.

One pass hashes every shingle and keeps one-permutation MinHash samples: the smallest hash of each of
``BINS`` bins. Samples give ``BANDS`` band keys. Folding the
(bin, sample) pairs into a parity bitmap gives the odd sketch: the population count of two sketches' XOR
estimates how many samples differ, precisely for high similarities.

Equal sets (by a 128-bit digest) are one class and only its smallest id goes on, so exact copies never
meet. Every bucket first compares its members with its hub, the one that meets most others in all its
buckets, such as the original of many copies: one pair a member. Only buckets whose other members are
not in one component by then compare these, by their sketches alone, in cells of bounded size that can go to
any task; what comes out is the pairs whose sketches allow a link, not all pairs. Components are exactly
those of all candidate pairs.

Defined cases: a null text is empty; rows with a null doc_id come back with a null component and are kept;
rows sharing a doc_id count as one document; other columns are not read; an empty table stays empty.
Chance of a missed link at the threshold: (1 - 0.85 ** 4) ** 32 for bands, 5 standard errors for sketches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import Words, connected, gram_hashes, likely_rows, mix64, slices, small_batches, stored

SHINGLE = 5
BINS = 2048  # MinHash samples
BANDS, ROWS = 32, 4
SKETCH_BITS = 2048
ERRORS = 5  # standard errors by which an estimate may miss the threshold
SMALL = 128  # shingles up to which a set is banded by permutations
CELL = 1024  # members of a bucket that one comparison of sketches holds

_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and the bounds of each text's share."""
    words = Words(texts, lower=True)
    h = words.hashes()
    counts = np.diff(words.bounds)
    grams = gram_hashes(h, size)
    same = words.text[: len(grams)] == words.text[size - 1 : size - 1 + len(grams)]
    owner = [words.text[: len(grams)][same]]
    value = [grams[same]]
    for n in range(1, size):  # whole sequences of short texts
        short = np.flatnonzero(counts == n)
        if len(short):
            at = words.bounds[short][:, None] + np.arange(n)
            value.append(gram_hashes(h[at].ravel(), n, seed=n)[::n])
            owner.append(short)
    owner, value = np.concatenate(owner), np.concatenate(value)
    if len(value) > int(same.sum()):
        order = np.argsort(owner, kind="stable")
        owner, value = owner[order], value[order]
    ends = np.searchsorted(owner, np.arange(len(texts) + 1))
    for a, b in zip(ends[:-1], ends[1:], strict=True):
        value[a:b].sort()
    new = np.ones(len(value), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    return value[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def _fill(low: np.ndarray) -> np.ndarray:
    """Give each empty bin the sample of the first filled bin in its own random order of bins."""
    pick = low.copy()
    order = np.arange(low.shape[1], dtype=np.uint64)
    rows, attempt = np.flatnonzero((pick == _NONE).any(1)), 0
    while len(rows):
        attempt += 1
        other = mix64(order + np.uint64(attempt * 7919)) % np.uint64(low.shape[1])
        part = pick[rows]
        pick[rows] = part = np.where(part == _NONE, low[rows][:, other.astype(np.int64)], part)
        rows = rows[(part == _NONE).any(1)]
    return pick


def _fold(samples: np.ndarray, kind: int) -> np.ndarray:
    """Band keys of rows of samples."""
    keys = np.full((len(samples), BANDS), np.uint64(kind + 1), np.uint64)
    for r in range(ROWS):
        keys = mix64(keys * np.uint64(0x9FB21C651E98DF25) + samples[:, r::ROWS])
    return mix64(keys + np.arange(BANDS, dtype=np.uint64))


def _sketch(values: np.ndarray, bounds: np.ndarray):
    """Band keys (one array per set), odd sketches (n, SKETCH_BITS / 8) and filled bins (n).

    Sets of up to ``SMALL`` shingles are banded by a permutation per sample, larger ones by the filled
    bins; around the border both, so that similar sets always share one way.
    """
    n, used = len(bounds) - 1, BANDS * ROWS
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    cell = owner * BINS + (mix64(values + np.uint64(0x51ED2701)) >> np.uint64(64 - 11)).astype(np.int64)
    low = np.full(n * BINS, _NONE, np.uint64)
    low[cell[::-1]] = values[::-1]  # values ascend within a set: the smallest of a bin is written last
    low = low.reshape(n, BINS)
    row, bin_ = np.nonzero(low != _NONE)
    bit = (mix64(low[row, bin_] + np.uint64(77)) >> np.uint64(64 - 11)).astype(np.int64)
    flips = np.bincount(row * SKETCH_BITS + bit, minlength=n * SKETCH_BITS) & 1
    sketch = np.packbits(flips.astype(np.uint8).reshape(n, SKETCH_BITS), axis=1)
    keys = [[] for _ in range(n)]
    large = np.flatnonzero(sizes >= SMALL * 0.8)
    if len(large):
        for i, k in zip(large, _fold(_fill(low[large].reshape(len(large), used, -1).min(2)), 0), strict=True):
            keys[i].append(k)
    small = np.flatnonzero((sizes > 0) & (sizes <= SMALL * 1.25))
    seeds = np.arange(1, used + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for part in np.array_split(small, max(1, -(-int(sizes[small].sum()) // 4096))):
        if len(part):
            own = np.concatenate([values[bounds[i] : bounds[i + 1]] for i in part])
            starts = np.concatenate([[0], np.cumsum(sizes[part])[:-1]])
            least = np.minimum.reduceat(mix64(own[:, None] ^ seeds), starts, axis=0)
            for i, k in zip(part, _fold(least, 1), strict=True):
                keys[i].append(k)
    return [np.concatenate(k).view(np.int64) if k else [] for k in keys], sketch, np.bincount(row, minlength=n)


SKETCHES = (
    "doc_id long, n_shingles long, digest binary, bands array<long>, sketch binary, samples int"
)


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text", 1 << 20):
        values, bounds = shingle_sets(batch.column("text"))
        keys, sketch, samples = _sketch(values, bounds)
        sizes = np.diff(bounds)
        digests = [
            hashlib.blake2b(values[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(bounds[:-1], bounds[1:], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(sizes.astype(np.int64)),
                pa.array(digests, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array([bytes(x) for x in sketch], pa.binary()),
                pa.array(samples.astype(np.int32)),
            ],
            ["doc_id", "n_shingles", "digest", "bands", "sketch", "samples"],
        )


_POPCOUNT = np.array([bin(i).count("1") for i in range(256)], np.uint8)


def allowed(a: np.ndarray, b: np.ndarray, sizes: tuple, samples: tuple, percent: int) -> np.ndarray:
    """Whether sketches (rows of bytes) of sets of given sizes and numbers of samples allow a link.

    The population count of the XOR gives the number of differing samples, so the number of equal ones;
    their share of the bins that either set fills estimates the similarity. Both errors are known: that
    of the samples (none when every shingle has a bin of its own) and that of colliding bits.
    """
    flipped = _POPCOUNT[a ^ b].sum(1).astype(float)
    differ = -SKETCH_BITS / 2 * np.log(np.maximum(1 - 2 * flipped / SKETCH_BITS, 1e-3))
    equal = (samples[0] + samples[1] - differ) / 2
    similarity = equal / np.maximum(*samples)
    fill = [BINS * (1 - np.exp(n * np.log1p(-1 / BINS))) for n in sizes]
    for _ in range(6):  # the bins that either set fills depend on the similarity
        union = (sizes[0] + sizes[1]) / (1 + np.clip(similarity, 0, 1))
        expected = BINS * (1 - np.exp(union * np.log1p(-1 / BINS)))
        clashes = np.maximum(0, fill[0] + fill[1] - expected * (1 + np.clip(similarity, 0, 1)))
        bins = np.maximum(samples[0] + samples[1] - equal - clashes, 1)
        similarity = equal / bins
    goal = percent / 100
    error = goal * (1 - goal) / bins * np.maximum(0, 1 - bins / union)
    error = error + (differ**2 / (2 * SKETCH_BITS) + clashes) / bins**2
    return similarity >= goal - ERRORS * np.sqrt(error) - 2 / bins


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            rows = [
                np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(len(batch), -1)
                for c in ("sa", "sb")
            ]
            sizes, samples = (tuple(batch.column(c).to_numpy() for c in names) for names in (("na", "nb"), ("ka", "kb")))
            yield batch.select(["a", "b"]).filter(pa.array(allowed(*rows, sizes, samples, percent)))

    return run


def _slots(sizes: np.ndarray, bands: list[list[int]]) -> np.ndarray:
    """Bands of sets at fixed places: those by bins, then those by permutations; 0 where there is none."""
    out = np.zeros((len(sizes), 2 * BANDS), np.int64)
    for i, (size, keys) in enumerate(zip(sizes.tolist(), bands, strict=True)):
        out[i, (0 if size >= SMALL * 0.8 else BANDS) :][: len(keys)] = keys
    return out


def _cell(rows: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Likely pairs of one cell: members of different components, of two blocks or within one."""
    rep, comp, size, filled, block = (
        rows.column(c).to_numpy() for c in ("rep", "comp", "n_shingles", "samples", "block")
    )
    sketch = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(len(rep), -1)
    slots = _slots(size, rows.column("bands").to_pylist())
    band = rows.column("band")[0].as_py()
    a, b = [], []
    left = np.flatnonzero(block == block.min()) if block.min() != block.max() else np.arange(len(rep))
    right = np.flatnonzero(block != block.min()) if block.min() != block.max() else left
    if rows.column("i")[0].as_py() != rows.column("j")[0].as_py() and right is left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)  # one block of the two is empty
    for k in left.tolist():
        other = right[(comp[right] != comp[k]) & ((right > k) if right is left else True)]
        other = other[100 * np.minimum(size[other], size[k]) >= percent * np.maximum(size[other], size[k])]
        if len(other):
            near = allowed(
                sketch[other], sketch[k], (size[other], size[k]), (filled[other], filled[k]), percent
            )
            other = other[near]
            # a pair that shares several bands comes out of the first of them
            same = (slots[other] == slots[k]) & (slots[k] != 0)
            other = other[slots[k][same.argmax(1)] == band]
            a.append(np.full(len(other), rep[k]))
            b.append(rep[other])
    if not a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(a), np.concatenate(b)
    return np.maximum(a, b), np.minimum(a, b)


def _cell_pairs(percent: int):
    def pairs(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        a, b = _cell(pa.Table.from_batches(rows), percent)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = [], None
        for batch in batches:
            if not len(batch):
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("band", "i", "j")])
            cuts = [0, *(np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1).tolist(), len(batch)]
            for x, y in zip(cuts[:-1], cuts[1:], strict=True):
                if last is not None and tuple(key[:, x]) != last:
                    yield pairs(held)
                    held = []
                held.append(batch.slice(x, y - x))
                last = tuple(key[:, x])
        if held:
            yield pairs(held)

    return run


def _confirmed(percent: int):
    """Pairs whose full sets are similar enough; rows come sorted by ``b`` so its set is kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, np.zeros(0, np.uint64)
        for batch in slices(batches, "ta", 1 << 20):
            values, bounds = shingle_sets(batch.column("ta"))
            keep = []
            for i, b in enumerate(batch.column("b").to_pylist()):
                if b != last:
                    last, hub = b, shingle_sets(batch.column("tb").slice(i, 1))[0]
                own = values[bounds[i] : bounds[i + 1]]
                both = len(np.intersect1d(own, hub, assume_unique=True))
                keep.append(100 * both >= percent * (len(own) + len(hub) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def near_duplicates(docs: DataFrame, percent: int = 85) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one for each row of ``docs``."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sketches = stored(texts.mapInArrow(_sketch_batches, SKETCHES), "sketches")
    classes = stored(
        sketches.where("doc_id is not null and n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("rep")),
        "classes",
    )
    # one row of sketches for each class: the rows of its smallest id
    members = (
        sketches.where("doc_id is not null and n_shingles > 0")
        .join(classes, "digest")
        .where("doc_id = rep")
        .dropDuplicates(["digest"])
    )
    reps = stored(members.select("rep", "n_shingles", "bands", "sketch", "samples"), "reps")
    bands = stored(reps.select("rep", "n_shingles", F.explode("bands").alias("band")), "bands")
    crowded = bands.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    # a text that many others are copies of meets more of them than they meet each other
    degree = F.sum("n").over(Window.partitionBy("rep"))
    active = stored(
        bands.join(crowded, "band").withColumn("degree", degree).drop("n"), "buckets"
    )
    crowd = stored(active.select(F.col("rep").alias("doc_id")).distinct(), "crowd")
    bodies = stored(_bodies(texts.where("doc_id is not null"), crowd), "bodies")
    hubs = stored(
        active.groupBy("band").agg(
            F.max_by(F.struct("rep", "n_shingles", "degree"), F.struct("degree", "rep")).alias("h")
        ).select("band", F.col("h.rep").alias("hub"), F.col("h.n_shingles").alias("hub_size"), "h.degree"),
        "hubs",
    )
    star = active.drop("degree").join(hubs.drop("degree"), "band").where(
        f"rep <> hub and 100 * least(n_shingles, hub_size) >= {percent} * greatest(n_shingles, hub_size)"
    )
    pairs = star.select(F.col("rep").alias("a"), F.col("hub").alias("b")).distinct()
    links = stored(confirm(_likely_pairs(pairs, reps, percent), bodies, percent), "links")
    # linked with one hub is known to be together
    best = hubs.select(F.col("hub").alias("b"), "degree").distinct()
    labels = links.join(best, "b").groupBy(F.col("a").alias("rep")).agg(
        F.max_by("b", F.struct("degree", "b")).alias("component")
    )
    # members that are still apart, hubs left out as they have met all others
    apart = (
        active.join(hubs.select("band", "hub"), "band")
        .where("rep <> hub")
        .join(labels, "rep", "left")
        .select("band", "rep", F.coalesce("component", "rep").alias("comp"))
    )
    apart = stored(apart, "apart")
    mixed = apart.groupBy("band").agg(
        F.count("*").alias("members"), F.min("comp").alias("low"), F.max("comp").alias("high")
    ).where("low <> high").select("band", F.ceil(F.col("members") / CELL).alias("blocks"))
    celled = (
        apart.join(mixed, "band")
        .withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "rep", "comp"
        )
        .join(reps.select("rep", "n_shingles", "sketch", "samples", "bands"), "rep")
    )
    more = (
        celled.repartition("band", "i", "j")
        .sortWithinPartitions("band", "i", "j")
        .mapInArrow(_cell_pairs(percent), "a long, b long")
    )
    found = stored(confirm(stored(more, "likely"), bodies, percent), "links")
    labels = stored(connected(links.union(found), "near"), "labels")
    component = classes.join(labels.withColumnRenamed("id", "rep"), "rep", "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    return (
        sketches.select("doc_id", "n_shingles", "digest")
        .join(component, "digest", "left")
        .select(
            "doc_id",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def _likely_pairs(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose sketches allow a link."""

    def side(x: str) -> DataFrame:
        return reps.select(
            F.col("rep").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"),
            F.col("samples").alias(f"k{x}"),
        )

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_likely(percent), "a long, b long")


def _bodies(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    return likely_rows(texts, wanted, "doc_id").join(wanted, "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))


def confirm(pairs: DataFrame, bodies: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of documents whose full shingle sets reach the threshold."""
    both = pairs.join(bodies.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a").join(
        bodies.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"
    )
    return both.sortWithinPartitions("b").mapInArrow(_confirmed(percent), "a long, b long")


def keep_first(docs: DataFrame, percent: int = 85) -> DataFrame:
    """One row of each group, with the columns of ``docs``, also among rows whose ids are null or repeated."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(whole, F.col("doc_id").cast("long").alias("number"))
    if not rows.groupBy("number").agg(F.count("*").alias("n")).where("n > 1 or number is null").isEmpty():
        # a number for each row, in the order of ids; equal rows are parted by their place, as they may be many
        placed = rows.withColumn("place", F.monotonically_increasing_id())
        placed = placed.orderBy(F.col("number").asc_nulls_last(), F.xxhash64("row.text"), "place")
        rows = stored(placed.select("row", F.monotonically_increasing_id().alias("number")), "rows")
    # the sketches of many short texts take more than the texts
    with small_batches(docs.sparkSession):
        found = near_duplicates(rows.select(F.col("number").alias("doc_id"), F.col("row.text").alias("text")), percent)
    dropped = found.where("not kept").select(F.col("doc_id").alias("number")).distinct()
    return rows.join(dropped, "number", "left_anti").select("row.*")
