"""The keyed order table and the metric history as plain Parquet folders laid out by date.

``KeyedTable`` holds one row per key, in folders of one day, month or year (``grain``) of its date. An upsert touches its
own folders and others that hold its keys (a scan of the key column of these others alone), keeps the newest row of
every key in them, and replaces just these folders. A key whose newest row has another date leaves the old one, as both
folders are written together. Reading needs neither a merge nor a window; :meth:`KeyedTable.on` opens the folder of one
date only.

Only rows that may have to give way are shuffled: a bitmap of hashes of the incoming keys goes to all tasks, and stored rows
whose bit is not set go from the old files to the new ones. The bitmap is bounded; where it is too full to tell keys apart, more rows
are shuffled, with the same result. The others are shuffled once, by key, and written from there, so that a folder gets
a file from every such task; a write whose files would be too many, or a table that has too many, is shuffled by date too,
and :meth:`KeyedTable.compact` does so at any time.

The touched folders are written beside the table before any folder is replaced, and then moved to their places. A write
that was cut off while it moved folders is finished from that copy by the next one, so a lost driver loses no row, and a
batch that is replayed gives the same table. One writer at a time, as for any table that Spark overwrites.

Deleted keys stay as marked rows, so that an older row that comes late cannot bring them back. Every touched folder
also gets a marked row without a key: dynamic overwrite only replaces folders that get rows, and one may lose all.

``DatedTable`` replaces whole dates; its rows need no merge.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from ledgerline.operators.latest import latest_per_key
from ledgerline.session import drop_scratch, file_system, path_exists
from ledgerline.sources.tables import TableUnavailable

DELETED = "_deleted"
WRITTEN = "_written"
VERSION = "_version"
FOLDER = "_from"  # first day of the folder
GRAINS = ("day", "month", "year")


SPLIT_BYTES = 64 << 20  # stored bytes from which rows that stay are told by the bitmap
MOST_BITS = 1 << 29  # of the bitmap: 64 MB
MOST_PIECES = 20_000  # files of one write that is not shuffled by date
MOST_FILES = 500  # files a folder may have on average before a write shuffles it by date
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _write_dates(rows: DataFrame, date: str, path: str, mode: str = "dynamic", even: bool = True) -> None:
    """Write rows in folders by date; ``even`` deals large dates over tasks and lets small ones share them."""
    (
        (rows.hint("rebalance", date) if even else rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .option("compression", "zstd")
        .partitionBy(date)
        .parquet(path)
    )


def _overwrite_dates(spark: SparkSession, copy: str, path: str) -> None:
    """Move the folders of a copy to the places of those of the table; after a cut, a second call moves the rest."""
    files, folder = file_system(spark, path)
    files.mkdirs(folder)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for found in files.listStatus(place(copy)):
        name = found.getPath().getName()
        if name.startswith(f"{FOLDER}="):
            files.delete(place(folder, name), True)
            if not files.rename(found.getPath(), place(folder, name)):
                raise OSError(f"cannot move {found.getPath()} to {path}")


class DatedTable:
    """A table whose dates are replaced as a whole."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, date: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.date = date

    def upsert(self, rows: DataFrame) -> None:
        """Replace the dates in ``rows``; other dates stay."""
        _write_dates(rows.select(*self.schema.names), self.date, self.path)

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def snapshot(self) -> DataFrame:
        if not self.exists():
            raise TableUnavailable(f"no table at {self.path}")
        return self.spark.read.schema(self.schema).parquet(self.path).select(*self.schema.names)


class KeyedTable:
    """One row per key: the newest by ``ordering``, or with ``late_rows="arrival"`` the one written last."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        key: str,
        date: str,
        ordering: str,
        late_rows: str = "event",
        volatile: Sequence[str] = (),
        keep_versions: bool = False,
        grain: str = "day",
    ):
        """``ordering`` is ISO text, compared as time; the other values settle ties, but for ``volatile`` columns.

        ``keep_versions`` also keeps the rows of every write, by version, for :meth:`snapshot` of the past.
        """
        if late_rows not in ("event", "arrival"):
            raise ValueError(f"unknown order {late_rows!r}")
        if grain not in GRAINS:
            raise ValueError(f"unknown grain {grain!r}")
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.key, self.date, self.ordering = key, date, ordering
        self.late_rows = late_rows
        self.volatile = set(volatile)
        self.keep_versions = keep_versions
        self.grain = grain
        self._stored = T.StructType(
            [
                *schema.fields,
                T.StructField(DELETED, T.BooleanType()),
                T.StructField(WRITTEN, T.TimestampType()),
                T.StructField(FOLDER, T.DateType()),
            ]
        )

    # -- reading ---------------------------------------------------------------------------------

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def _rows(self) -> DataFrame:
        """All stored rows, marked ones included."""
        return self.spark.read.schema(self._stored).parquet(self.path).select(*self._stored.names)

    def snapshot(self, as_of: int | None = None) -> DataFrame:
        """The table now, or as of a kept version."""
        if not self.exists():
            raise TableUnavailable(f"no table at {self.path}")
        if as_of is None:
            rows = self._rows()
        else:
            rows = self._newest(self._versions().where(F.col(VERSION) <= as_of).select(*self._stored.names))
        return rows.where(~F.col(DELETED)).select(*self.schema.names)

    def on(self, date) -> DataFrame:
        """The rows of one date."""
        day = F.lit(date).cast("date")
        if not self.exists():
            raise TableUnavailable(f"no table at {self.path}")
        # one folder of each grain, as a table may have been written by more than one
        folders = [F.date_trunc(grain, day).cast("date") for grain in GRAINS]
        rows = self._rows().where(F.col(FOLDER).isin(folders) & (F.col(self.date) == day) & ~F.col(DELETED))
        return rows.select(*self.schema.names)

    def _versions(self) -> DataFrame:
        if not (self.keep_versions and path_exists(self.spark, f"{self.path}_versions")):
            raise TableUnavailable(f"no versions are kept of {self.path}")
        schema = T.StructType([*self._stored.fields, T.StructField(VERSION, T.LongType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}_versions")

    def versions(self) -> DataFrame:
        """Kept versions with the number of rows each brought."""
        return self._versions().groupBy(VERSION).agg(F.count_distinct(self.key).alias("rows"))

    # -- writing ---------------------------------------------------------------------------------

    def upsert(self, rows: DataFrame, version: int | None = None) -> None:
        """Put in rows by key; a row older than the stored one changes nothing."""
        self._merge(rows.withColumn(DELETED, F.lit(False)), version)

    def delete(self, rows: DataFrame, version: int | None = None) -> None:
        """Delete the keys in ``rows``, which also carries the ordering field as time of deletion."""
        given = set(rows.columns)
        blank = [
            F.col(f.name) if f.name in given else F.lit(None).cast(f.dataType).alias(f.name)
            for f in self.schema.fields
        ]
        self._merge(rows.select(*blank).withColumn(DELETED, F.lit(True)), version)

    def _newest(self, rows: DataFrame) -> DataFrame:
        values = [
            F.col(name).desc_nulls_last()
            for name in self.schema.names
            if name not in self.volatile and name != self.key
        ]
        event = [F.col(self.ordering).try_cast("timestamp").desc_nulls_last(), F.col(DELETED).desc(), *values]
        written = F.col(WRITTEN).desc()
        order = [*event, written] if self.late_rows == "event" else [written, *event]
        return latest_per_key(rows, [self.key], order)

    def _folders(self) -> set[dt.date | None]:
        """The folders there are."""
        files, folder = file_system(self.spark, self.path)
        names = [found.getPath().getName() for found in files.listStatus(folder)]
        days = [name.split("=", 1)[1] for name in names if name.startswith(f"{FOLDER}=")]
        return {None if day == NO_DATE else dt.date.fromisoformat(day) for day in days}

    def _inside(self, folders: Iterable[dt.date | None]) -> Column:
        found = F.col(FOLDER).isin([d for d in folders if d is not None])
        return found | F.col(FOLDER).isNull() if None in folders else found

    def _place(self, rows: int) -> tuple[Column, Column]:
        """Bucket and bit of a key in the bitmap of so many rows."""
        bits = min(MOST_BITS, max(1 << 15, 1 << (8 * rows).bit_length()))
        place = F.xxhash64(self.key).bitwiseAND(F.lit(bits - 1)) + 1
        return F.bitmap_bucket_number(place), F.bitmap_bit_position(place)

    def _split(self, stored: DataFrame, bitmap: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
        """Stored rows whose key is not among the incoming ones for certain, and the others."""
        bucket, bit = self._place(rows)
        byte = "conv(hex(substring(_bits, cast(_bit div 8 + 1 as int), 1)), 16, 10)"
        marked = (
            stored.withColumns({"_bucket": bucket, "_bit": bit})
            .join(F.broadcast(bitmap), "_bucket", "left")
            .withColumn("_hit", F.expr(f"coalesce(getbit(cast({byte} as int), cast(_bit % 8 as int)), 0) = 1"))
        )
        return tuple(marked.where(on).select(*self._stored.names) for on in (~F.col("_hit"), F.col("_hit")))

    def _merge(self, rows: DataFrame, version: int | None) -> None:
        self._finish()
        micros = time.time_ns() // 1000
        incoming = rows.withColumn(WRITTEN, F.timestamp_micros(F.lit(micros)))
        folder = F.date_trunc(self.grain, F.col(self.date)).cast("date")
        incoming = incoming.withColumn(FOLDER, folder).select(*self._stored.names)
        # read by the lookup, by the bitmap, by the merge and by the kept version
        incoming = incoming.where(F.col(self.key).isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
        bitmap = None
        try:
            found = incoming.groupBy(FOLDER).count().collect()  # spans of time, not rows
            touched = {row[0] for row in found}
            if not touched:
                return
            moved, stay, even = incoming, None, False
            if self.exists():
                there = self._folders()
                if others := there - touched:
                    here = self._rows().where(self._inside(others)).select(self.key, FOLDER)
                    here = here.join(incoming.select(self.key), self.key, "left_semi").select(FOLDER)
                    touched |= {row[0] for row in here.distinct().collect()}
                stored = self._rows().where(self._inside(touched) & F.col(self.key).isNotNull())
                files, at = file_system(self.spark, self.path)
                size = files.getContentSummary(at)
                even = size.getFileCount() > MOST_FILES * max(len(there), 1)
                number = sum(row[1] for row in found)
                if size.getLength() >= SPLIT_BYTES and number <= MOST_BITS and not even:
                    bucket, bit = self._place(number)
                    bitmap = incoming.groupBy(bucket.alias("_bucket")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
                    stay, stored = self._split(stored, bitmap.persist(), number)
                moved = stored.unionByName(incoming)
            if self.keep_versions:
                kept = incoming.withColumn(VERSION, F.lit(version or micros).cast("long"))
                _write_dates(kept, VERSION, f"{self.path}_versions", even=False)
            merged = self._newest(moved)
            tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            even = even or tasks * len(touched) > MOST_PIECES
            self._replace(merged if stay is None else stay.unionByName(merged), touched, even)
        finally:
            incoming.unpersist()
            if bitmap is not None:
                bitmap.unpersist()

    def _replace(self, rows: DataFrame, folders: Iterable, even: bool = True) -> None:
        marks = self.spark.createDataFrame([(d,) for d in folders], T.StructType([self._stored[FOLDER]]))
        blank = {f.name: F.lit(None).cast(f.dataType) for f in self._stored.fields if f.name != FOLDER}
        marks = marks.withColumns(blank | {DELETED: F.lit(True)})
        staged = rows.select(*self._stored.names).unionByName(marks)
        _write_dates(staged, FOLDER, f"{self.path}_staged", "static", even)
        self._finish()

    def _finish(self) -> None:
        """Replace the folders of a finished copy that lies beside the table."""
        staged = f"{self.path}_staged"
        if path_exists(self.spark, f"{staged}/_SUCCESS"):
            _overwrite_dates(self.spark, staged, self.path)
            drop_scratch(self.spark, staged)

    def compact(self) -> None:
        """Write every folder anew in files of an even size; the rows stay the same."""
        if not self.exists():
            raise TableUnavailable(f"no table at {self.path}")
        self._finish()
        self._replace(self._rows().where(F.col(self.key).isNotNull()), self._folders())
