"""Sharding by histogram sort: probe key boundaries, count exactly below them, refine, exchange once.

Keys are (hash of the text, doc_id, tie), so equal texts are neighbours; the tie is a hash of a row's place in the
table. Every round counts the bytes and rows
between all probes in one pass over the keys; only these counts, one pair a probe, come to the driver.
A splitter is settled when the bytes below it are within ``tolerance`` of its target. Probes part keys by
the hash alone as long as that can meet the tolerance, which keeps equal texts together; only a group too
large for that is parted by doc_id, and rows equal in both by their ties. Shards are made of several ranges, so that no task sorts a whole
shard, and the counts below the splitters give each range its first slot: nothing is counted again.

Law ``bytes``: sizes (UTF-8 bytes plus 1) of shards differ from the mean by the tolerance and one row at
most, also when most rows are equal. Null texts have size 1. Null ids sort first. Equal rows get
different slots. An empty table gives an empty result. Very long texts are rows like others. Other columns are kept, whatever
their names, but for those named like an added one, which are replaced. ``docs`` is read twice, so it must be a table or a
plan that gives the same rows in the same order each time.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import stored

PROBES = 16  # probes for each splitter and round
LOWEST = -(1 << 63)
TIES = 1 << 31

Key = tuple[int, int, int]


class Probes(NamedTuple):
    """Sorted boundaries (hash, id, tie); a row is below a boundary when its key is smaller."""

    hash: np.ndarray
    id: np.ndarray
    tie: np.ndarray

    @classmethod
    def of(cls, keys: list[Key]) -> "Probes":
        return cls(*(np.array([k[c] for k in keys], np.int64) for c in range(3)))

    def place(self, h: np.ndarray, i: np.ndarray, t: np.ndarray) -> np.ndarray:
        """How many boundaries are at or below each key."""
        first = np.searchsorted(self.hash, h, "left")
        last = np.searchsorted(self.hash, h, "right")
        for value in np.unique(h[last > first]):  # keys that share a boundary's hash
            rows = np.flatnonzero(h == value)
            a, b = np.searchsorted(self.hash, value, "left"), np.searchsorted(self.hash, value, "right")
            last[rows] = a
            for k in range(a, b):
                last[rows] += (i[rows] > self.id[k]) | ((i[rows] == self.id[k]) & (t[rows] >= self.tie[k]))
        return last


class Space(NamedTuple):
    """All keys as one line of integers, ids from ``low`` to ``high`` (null ids before them)."""

    low: int
    high: int

    @property
    def ids(self) -> int:
        return self.high - self.low + 2

    def number(self, key: Key) -> int:
        h, i, t = key
        return ((h - LOWEST) * self.ids + (0 if i == LOWEST else i - self.low + 1)) * TIES + t

    def key(self, number: int) -> Key:
        rest, t = divmod(number, TIES)
        h, i = divmod(rest, self.ids)
        return h + LOWEST, LOWEST if i == 0 else i + self.low - 1, t

    def between(self, low: int, high: int, n: int) -> list[int]:
        """``n`` numbers strictly between two: by hash if there is one between, else by id, else by tie."""
        for unit in (self.ids * TIES, TIES, 1):
            first, last = low // unit + 1, (high - 1) // unit
            if first <= last:
                return sorted({(first + (last - first) * k // max(1, n - 1)) * unit for k in range(n)})
        return []


def _counter(probes: Probes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(probes.hash) + 1
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for batch in batches:
            h, i, t, s = (batch.column(c).to_numpy() for c in ("hash", "id", "tie", "size"))
            at = probes.place(h, i, t)
            np.add.at(size, at, s)
            rows += np.bincount(at, minlength=n)
        full = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full), pa.array(size[full]), pa.array(rows[full])], ["at", "size", "rows"]
        )

    return run


def counts_below(keys: DataFrame, probes: Probes) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and rows below each boundary, and in all as the last entry."""
    found = (
        keys.mapInArrow(_counter(probes), "at long, size long, rows long")
        .groupBy("at")
        .agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"))
        .toPandas()
    )
    size, rows = np.zeros(len(probes.hash) + 1, np.int64), np.zeros(len(probes.hash) + 1, np.int64)
    size[found["at"]], rows[found["at"]] = found["size"], found["rows"]
    return np.cumsum(size), np.cumsum(rows)


def splitters(keys: DataFrame, shards: int, per_shard: int, tolerance: float) -> tuple[Probes, np.ndarray]:
    """Boundaries that part all bytes evenly, and the rows below each (and in all).

    Between shards the tolerance is a share of a shard's bytes; between the ranges of one shard a quarter of
    a range is near enough. A boundary is also settled when one row is all that lies around its target.
    """
    n = shards * per_shard
    total, rows = (int(x[-1]) for x in counts_below(keys, Probes.of([])))
    real = F.when(F.col("id") != LOWEST, F.col("id"))
    ids = keys.agg(F.min(real), F.max(real)).first()
    space = Space(ids[0] or 0, ids[1] or 0)
    known = {0: (0, 0), space.ids * TIES << 64: (total, rows)}
    targets = [total * j // n for j in range(1, n)]
    while True:
        order = sorted(known)
        below, count = (np.array([known[k][x] for k in order]) for x in (0, 1))
        probes: set[int] = set()
        chosen = []
        for j, target in enumerate(targets, 1):
            allowed = tolerance * total / shards if j % per_shard == 0 else 0.25 * total / n
            at = min(max(int(np.searchsorted(below, target, "right")) - 1, 0), len(order) - 2)
            best = min((at, at + 1), key=lambda k: abs(below[k] - target))
            chosen.append(order[best])
            if abs(below[best] - target) > allowed and count[at + 1] - count[at] > 1:
                probes.update(p for p in space.between(order[at], order[at + 1], PROBES) if p not in known)
        if not probes:
            break
        asked = sorted(probes)
        size, row = counts_below(keys, Probes.of([space.key(p) for p in asked]))
        known.update({p: (int(size[k]), int(row[k])) for k, p in enumerate(asked)})
    top = ((1 << 63) - 1, (1 << 63) - 1, TIES)
    bounds = Probes.of([space.key(c) if c < space.ids * TIES << 64 else top for c in chosen])
    return bounds, np.array([known[c][1] for c in chosen] + [rows])


def histogram_sort(
    docs: DataFrame, shards: int = 8, text: str = "text", doc_id: str = "doc_id", tolerance: float = 0.002
) -> DataFrame:
    """Add ``size``, ``shard`` (0 to shards - 1) and ``slot`` (0, 1, ... within a shard) to every row."""
    spark = docs.sparkSession
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    place = F.xxhash64(F.monotonically_increasing_id())
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in ("size", "shard", "slot")]).alias("row"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.xxhash64(body).alias("hash"),
        F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(LOWEST)).alias("id"),
        F.pmod(place, F.lit(TIES)).cast("long").alias("tie"),
    )
    keys = stored(rows.select("hash", "id", "tie", "size"), "keys")
    per_shard = max(1, -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards))
    ranges = shards * per_shard
    bounds, below = splitters(keys, shards, per_shard, tolerance)
    # first slot of each range: rows below it less those below its shard
    start = np.concatenate([[0], below[:-1]])
    first = start - start[np.arange(ranges) // per_shard * per_shard]

    @F.pandas_udf("int")
    def range_of(h: pd.Series, i: pd.Series, t: pd.Series) -> pd.Series:
        return pd.Series(bounds.place(h.to_numpy(), i.to_numpy(), t.to_numpy()).astype(np.int32))

    @F.pandas_udf("long")
    def first_slot(r: pd.Series) -> pd.Series:
        return pd.Series(first[r.to_numpy()])

    ranged = rows.withColumn("range", range_of("hash", "id", "tie")).repartitionById(ranges, F.col("range"))
    within = F.row_number().over(Window.partitionBy("range").orderBy("hash", "id", "tie")) - 1
    return ranged.select(
        "row",
        "size",
        (first_slot("range") + within).cast("long").alias("slot"),
        F.floor(F.col("range") / per_shard).cast("int").alias("shard"),
    ).select("row.*", "size", "slot", "shard")


def report(docs: DataFrame, shards: int = 8) -> DataFrame:
    """Digest columns of ``documents``."""
    light = docs.select(
        "doc_id", "text", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).cast("long").alias("text_crc32")
    )
    placed = histogram_sort(light, shards)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
