"""Customer segmentation by exact quantile bands of recency, frequency and spend."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import money_sum
from ledgerline.operators.ordering import ntile

STEPS_PER_OCTAVE = 4096
MEASURES = {
    "recency_days": "recency_band",
    "frequency": "frequency_band",
    "spend": "monetary_band",
}


def _scale(value: Column) -> Column:
    """A bucket number that grows with the value: 4,096 per doubling, so one spans 0.02 percent."""
    size = F.floor(F.log2(F.abs(value) + 1.0) * float(STEPS_PER_OCTAVE))
    # never null, so that the join on the bucket adds no filter and both its sides share one shuffle
    return F.coalesce(F.when(value < 0, -size).otherwise(size), F.lit(0))


def discrete_quantiles(
    df: DataFrame, columns: Sequence[str], fractions: Sequence[float]
) -> DataFrame:
    """One row with an array per column: for each fraction, the smallest value with at least that
    share of the non-null values at or below it.

    Exact without sorting everything in one task or holding all values in one buffer. Equal values
    are counted first (a value shared by a third of the rows becomes one row per task), the counts
    fall into ordered buckets, bucket totals give each bucket's offset, and only the distinct values
    within a bucket are ranked. All columns share one pass over the input.
    """
    pairs = F.array(
        *(
            F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("value"))
            for c in columns
        )
    )
    counted = (
        df.select(F.inline(pairs))
        .filter(F.col("value").isNotNull())
        .groupBy("measure", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", _scale(F.col("value")))
    )
    measure = Window.partitionBy("measure")
    before = measure.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        counted.groupBy("measure", "bucket")
        .agg(F.sum("n").alias("bucket_n"))
        .select(
            "measure",
            "bucket",
            F.coalesce(F.sum("bucket_n").over(before), F.lit(0)).alias("offset"),
            F.sum("bucket_n").over(measure).alias("total"),
        )
    )
    within = Window.partitionBy("measure", "bucket").orderBy("value")
    # no broadcast hint: Spark decides by the size of the offsets
    ranked = counted.join(offsets, ["measure", "bucket"]).withColumn(
        "at_or_below", F.col("offset") + F.sum("n").over(within)
    )

    def cut(column: str, fraction: float) -> Column:
        reached = F.col("at_or_below") >= F.ceil(F.col("total") * F.lit(fraction))
        return F.min(F.when((F.col("measure") == column) & reached, F.col("value")))

    return ranked.agg(*(F.array(*(cut(c, q) for q in fractions)).alias(c) for c in columns))


def customer_activity(orders: DataFrame) -> DataFrame:
    """Last order date, number of orders and spend per customer."""
    return orders.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count("order_id").alias("frequency"),
        money_sum("total_amount").alias("spend"),
    )


def customer_segments(activity: DataFrame, as_of: Column, bands: int = 4) -> DataFrame:
    """Add recency in days and bands from 1 (lowest values) to ``bands`` for each measure.

    Equal values always share a band. A band is one plus the number of cut points below the value,
    so the cut points travel as one broadcast row and no customer row is shuffled to be ranked.
    """
    recency = F.date_diff(as_of, F.col("last_order_date").cast("date")).alias("recency_days")
    # next to the column it comes from, so that cuts and scoring ask for the same aggregates in the
    # same order and Spark shuffles the activity once for both
    at = activity.columns.index("last_order_date") + 1
    measured = activity.select(*activity.columns[:at], recency, *activity.columns[at:])
    cuts = discrete_quantiles(measured, list(MEASURES), [i / bands for i in range(1, bands)])
    cuts = cuts.toDF(*(f"_{column}" for column in MEASURES))
    scored = measured.crossJoin(F.broadcast(cuts))
    for column, band in MEASURES.items():
        value = F.col(column).cast("double")
        band_number = F.lit(1)
        for step in range(bands - 1):
            above = F.col(f"_{column}")[step] < value
            band_number = band_number + F.when(above, F.lit(1)).otherwise(F.lit(0))
        scored = scored.withColumn(band, F.when(value.isNotNull(), band_number))
    return scored.drop(*(f"_{column}" for column in MEASURES))


def customer_ntiles(activity: DataFrame, as_of: Column, bands: int = 4) -> DataFrame:
    """Add recency in days and, for each measure, equal-sized bands from 1 (lowest values) to ``bands``.

    Unlike :func:`customer_segments`, equal values may part: the customer id settles their order. A null measure ranks first.
    """
    measured = activity.withColumn("recency_days", F.date_diff(as_of, F.col("last_order_date").cast("date")))
    for column, band in MEASURES.items():
        order = [F.col(column).asc_nulls_first(), F.col("customer_id").asc_nulls_first()]
        measured = ntile(measured, order, bands, band, name=band)
    return measured
