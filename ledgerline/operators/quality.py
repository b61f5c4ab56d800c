"""Data-quality checks as rows: check, severity, observed, threshold, passed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MINIMUM_ROWS = 50


class DataQualityError(RuntimeError):
    """A check of severity ``error`` failed."""


def volume_checks(df: DataFrame, minimum_rows: int = MINIMUM_ROWS) -> DataFrame:
    """Two rows from one count: ``not_empty`` (error) and ``minimum_volume`` (warn)."""
    return checks_on_count(df.agg(F.count("*").alias("observed")), minimum_rows)


def checks_on_count(counted: DataFrame, minimum_rows: int = MINIMUM_ROWS) -> DataFrame:
    """The volume checks on a one-row count named ``observed``."""
    checks = F.array(
        _check("not_empty", "error", 1), _check("minimum_volume", "warn", minimum_rows)
    )
    return counted.select("observed", F.explode(checks).alias("c")).select(
        "c.check",
        "c.severity",
        "observed",
        "c.threshold",
        (F.col("observed") >= F.col("c.threshold")).alias("passed"),
    )


def _check(name: str, severity: str, threshold: int):
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(severity).alias("severity"),
        F.lit(threshold).cast("bigint").alias("threshold"),
    )


def labelled_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """``UNION ALL`` of one labelled row count per table."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    union = counts[0]
    for other in counts[1:]:
        union = union.unionByName(other)
    return union


def enforce(checks: DataFrame) -> list:
    """Run the checks; raise if one of severity ``error`` failed, else return all rows."""
    rows = checks.collect()  # one row per check
    failed = [row["check"] for row in rows if row["severity"] == "error" and not row["passed"]]
    if failed:
        raise DataQualityError(f"failed checks: {', '.join(failed)}")
    return rows
