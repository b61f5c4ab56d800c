"""Shared helpers: scratch tables, words of Arrow text batches as numpy arrays, connected components."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import ExitStack, contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import drop_scratch, scratch_path

WORD_BREAK = r"[\x20\x09-\x0D]+"
BREAKS = " \t\n\x0b\x0c\r"

_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# one random odd-multiplier polynomial over random 64-bit byte codes; fixed seed, so all tasks agree
_CODES = np.random.Generator(np.random.PCG64(20240229)).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_open: list[list[str]] = []  # scratch folders made within each call of ``finished``


def stored(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage and survives lost executors.

    A reader decodes up to 4096 rows of a row group at once: ``group_bytes`` bounds that where rows are large.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    sizes = {"parquet.block.size": group_bytes, "parquet.page.size.row.check.min": 10} if group_bytes else {}
    df.write.options(**sizes).parquet(path)
    for made in _open:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def finished(build: Callable[[], DataFrame], name: str) -> DataFrame:
    """The stored result of ``build``; the scratch folders that it needed on the way are deleted."""
    made: list[str] = []
    _open.append(made)
    try:
        result = stored(build(), name)
    finally:
        _open.pop()
    for path in made[:-1]:
        drop_scratch(result.sparkSession, path)
    return result


@contextmanager
def _lowered(spark: SparkSession, key: str, most: int) -> Iterator[None]:
    """The setting is ``most`` at most; zero and less stand for no bound."""
    before = spark.conf.get(key)
    had = int(before.rstrip("b"))
    spark.conf.set(key, str(min(most, had) if had > 0 else most))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000, most_bytes: int | None = None) -> Iterator[None]:
    """Rows with long texts go to Python so many at a time, which bounds what executor and worker hold beside the heap."""
    with ExitStack() as held:
        held.enter_context(_lowered(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", rows))
        if most_bytes:
            held.enter_context(_lowered(spark, "spark.sql.execution.arrow.maxBytesPerBatch", most_bytes))
        yield


def few_groups(spark: SparkSession, most: int = 8):
    """Lists of large rows are collected for so many groups at once; further rows are sorted, which spills."""
    return _lowered(spark, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", most)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        _powers[name] = have = np.multiply.accumulate(steps)
    return have[:n]


def range_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte ranges [start, end); equal bytes give equal hashes anywhere."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODES[data] * _power("p", _BASE, len(data)), out=sums[1:])
    return mix64((sums[end] - sums[start]) * _power("i", _BASE_INVERSE, len(data) + 1)[start] + (end - start).astype(np.uint64))


class Words:
    """The words of a batch of texts: byte ranges into ``data``, in order, and each text's share."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        raw = texts.buffers()[2]
        data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw else np.zeros(0, np.uint8)
        self.offsets = offsets - offsets[0]
        self.data = _LOWER[data] if lower else data
        inside = ~_IS_BREAK[data]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        edges = self.offsets[(self.offsets > 0) & (self.offsets < len(data))]
        first[edges] = inside[edges]
        last[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.bounds = np.searchsorted(self.start, self.offsets)  # words of text i: bounds[i]..bounds[i+1]
        self.text = np.repeat(np.arange(len(texts)), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        return range_hashes(self.data, self.start, self.end)


def gram_hashes(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries of ``h`` (by position, also across texts)."""
    count = max(0, len(h) - n + 1)
    out = np.full(count, np.uint64(0x1234567 + seed), np.uint64)
    factor = np.uint64(0xA0761D6478BD642F ^ (seed << 1))
    for k in range(n):
        out *= factor
        out += h[k : k + count]
        out ^= out >> np.uint64(29)
    return mix64(out)


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one holds about ``most_bytes`` of text, and one text at least."""
    for batch in batches:
        texts = batch.column(column).cast(pa.large_string())
        if not len(texts):
            continue
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most_bytes, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def body_hash(raw: bytes) -> int:
    """Tells texts of one id apart."""
    return int.from_bytes(hashlib.blake2b(raw, digest_size=8).digest(), "little", signed=True)


def with_body(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Only rows whose text is the wanted one of its id."""
    for batch in slices(batches, "text"):
        same = [
            body_hash((text or "").encode()) == want
            for text, want in zip(batch.column("text").to_pylist(), batch.column("body").to_pylist(), strict=True)
        ]
        yield batch.filter(pa.array(same, pa.bool_()))


def chained(one, two):
    """Two functions for ``mapInArrow``, one after the other."""
    return lambda batches: two(one(batches))


LEAST_BITS, MOST_BITS = 25, 28  # bitmaps of 4 to 32 MB


def _bits(keys: DataFrame, width: int) -> DataFrame:
    """Rows (word, bits) of the bitmap of the ``width`` leading bits of 64-bit keys; words without a bit are left out."""
    lead = F.shiftrightunsigned("key", 64 - width)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), lead.bitwiseAND(F.lit(63).cast("long")).cast("int"))
    return keys.groupBy(F.shiftright(lead, 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def bitmap(keys: DataFrame) -> np.ndarray:
    """Bitmap of the leading bits of 64-bit keys, eight bits or more a key up to 32 MB.

    It only saves shuffling what cannot match: the join behind it tells. Beyond 32 million keys it fills up (30 percent set
    with 100 million keys, 84 with 500 million) and saves less, but never grows.
    """
    width = min(MOST_BITS, max(LEAST_BITS, (8 * keys.count()).bit_length()))
    rows = _bits(keys, width).toArrow()
    bits = np.zeros(1 << (width - 6), np.uint64)
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
    return bits


def in_bitmap(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key >> np.uint64(64 - 6 - (len(bits).bit_length() - 1))
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _in_bits(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("_key").to_numpy().view(np.uint64)
            yield batch.drop_columns(["_key"]).filter(pa.array(in_bitmap(bits, key)))

    return run


def likely_rows(rows: DataFrame, wanted: DataFrame, column: str) -> DataFrame:
    """``rows`` that may join ``wanted`` on ``column``, by a bitmap: what a join would shuffle in vain goes."""
    bits = bitmap(wanted.select(F.xxhash64(column).alias("key")))
    return rows.withColumn("_key", F.xxhash64(column)).mapInArrow(_in_bits(bits), rows.schema)


def likely_rows_of(rows: DataFrame, wanted: DataFrame, columns: list[str], width: int = LEAST_BITS) -> DataFrame:
    """``rows`` that may join ``wanted`` on ``columns``, built in: a row for each 64 bits of the bitmap goes to every executor.

    That is 2 ** 19 rows at most, some 25 MB, and fewer while ``wanted`` is short: it never grows beyond.
    """
    key = F.xxhash64(*columns)
    bits = stored(_bits(wanted.select(key.alias("key")), width), "bits")
    lead = F.shiftrightunsigned(key, 64 - width)
    place = lead.bitwiseAND(F.lit(63).cast("long")).cast("int")
    return (
        rows.withColumn("_word", F.shiftright(lead, 6))
        .join(F.broadcast(bits.withColumnsRenamed({"word": "_word", "bits": "_bits"})), "_word")
        .where(F.getbit("_bits", place) == 1)
        .select(*rows.columns)
    )


def connected(links: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of links (a, b): rows (id, component), component = smallest id reachable.

    Alternates two steps on directed edges (from larger to smaller id) until every component is a star
    around its smallest id: each node's larger neighbours are tied to its smallest one, then its smaller
    ones. Chains shrink geometrically; a node's row count never grows, and no component is gathered anywhere.
    """
    edges = stored(
        links.selectExpr("greatest(a, b) as u", "least(a, b) as v").where("u > v").distinct(), name
    )
    while not _stars(edges):
        # large star: every larger neighbour (and the node itself) points to the node's smallest neighbour
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).selectExpr("u", "least(u, m) as m")
        large = both.join(least, "u").where("v > u").selectExpr("v as u", "m as v")
        # small star: smaller neighbours and the node itself point to the smallest of them
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(small_least, "u")
            .selectExpr("case when v = m then u else v end as u", "m as v")
            .where("u > v")
            .distinct()
        )
        edges = stored(small, name)
    return edges.selectExpr("u as id", "v as component").union(
        edges.selectExpr("v as id", "v as component").distinct()
    )


def _stars(edges: DataFrame) -> bool:
    """Whether no node has two smaller neighbours, and no smaller neighbour has one itself."""
    centre = edges.select(F.col("v").alias("u"), F.lit(0).alias("out"), F.lit(1).alias("into")).distinct()
    leaf = edges.select("u", F.lit(1).alias("out"), F.lit(0).alias("into"))
    sums = leaf.unionAll(centre).groupBy("u").agg(F.sum("out").alias("out"), F.sum("into").alias("into"))
    return sums.where("out > 1 or (out > 0 and into > 0)").isEmpty()
