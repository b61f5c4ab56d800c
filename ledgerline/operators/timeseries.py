"""Daily revenue series, moving averages, weekday seasonality and levels.

``series_keys`` splits the work into independent series (per product, per customer, ...). Without
keys there is one series, and what enters its window is one row per day, not one row per order.
Frames count rows: a day without orders is absent unless ``fill_gaps`` puts it in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ledgerline.functions import day_name, day_of_week, growth, midnight, money_mean, money_sum
from ledgerline.operators.ordering import over_blocks

MOVING_AVERAGES = {"ma_7": 7, "ma_14": 14, "ma_30": 30}
WEEK = 7


def _by_date(series_keys: Sequence[str], date: str = "order_date") -> WindowSpec:
    return Window.partitionBy(*series_keys).orderBy(date)


def daily_revenue(
    orders: DataFrame, series_keys: Sequence[str] = (), created_at: Column | None = None
) -> DataFrame:
    """Revenue, orders and mean order per date, with the weekday. One row per date with data.

    Rows are in no order; :func:`ordered` puts them in date order for people to read.
    """
    daily = orders.groupBy(*series_keys, "order_date").agg(
        money_sum("total_amount").alias("revenue"),
        F.count("order_id").alias("order_count"),
        money_mean("total_amount").alias("avg_order_value"),
    )
    daily = _with_weekday(daily.withColumn("order_date", midnight("order_date")))
    return daily if created_at is None else daily.withColumn("created_at", created_at)


def ordered(table: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """A daily series by date, a weekday table by weekday (Sunday first), series by series."""
    by = "order_date" if "order_date" in table.columns else "day_of_week"
    return table.orderBy(*series_keys, by)


def _with_weekday(daily: DataFrame) -> DataFrame:
    return daily.withColumns(
        {"day_of_week": day_of_week("order_date"), "day_name": day_name("order_date")}
    )


def fill_gaps(daily: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Add the missing dates between the first and last date of each series, with zero revenue.

    Each row produces the dates up to the row after it, so no calendar table or join is needed.
    """
    date = F.col("order_date").cast("date")
    following = F.lead("order_date").over(_by_date(series_keys))
    filled = daily.select(
        *series_keys,
        "order_date",
        "revenue",
        "order_count",
        "avg_order_value",
        F.coalesce(F.date_sub(following, 1), date).alias("_until"),
    ).withColumn("_date", F.explode_outer(F.sequence(date, F.col("_until"))))
    has_data = midnight("_date").eqNullSafe(F.col("order_date"))
    filled = filled.select(
        *series_keys,
        midnight("_date").alias("order_date"),
        F.when(has_data, F.col("revenue")).otherwise(F.lit(0.0)).alias("revenue"),
        F.when(has_data, F.col("order_count")).otherwise(F.lit(0)).alias("order_count"),
        F.when(has_data, F.col("avg_order_value")).alias("avg_order_value"),
    )
    return _with_weekday(filled)


def moving_averages(
    daily: DataFrame,
    series_keys: Sequence[str] = (),
    windows: dict[str, int] = MOVING_AVERAGES,
) -> DataFrame:
    """Add trailing means over the last n rows; the first rows average what there is."""
    by_date = _by_date(series_keys)
    return daily.withColumns(
        {
            name: money_mean("revenue", by_date.rowsBetween(-(rows - 1), 0))
            for name, rows in windows.items()
        }
    )


def long_moving_averages(
    series: DataFrame, order: Sequence[Column], value: str = "revenue", windows: dict[str, int] = MOVING_AVERAGES
) -> DataFrame:
    """:func:`moving_averages` of one series of any length (hours, single events), block by block."""

    def columns(by_time: WindowSpec) -> dict[str, Column]:
        return {name: money_mean(value, by_time.rowsBetween(-(rows - 1), 0)) for name, rows in windows.items()}

    return over_blocks(series, order, columns, before=max(windows.values()) - 1, name="moving-averages")


def fill_time_gaps(series: DataFrame, time: str, step: str, zero: Sequence[str]) -> DataFrame:
    """One series with a row at every ``step`` ('1 hour') between its first and last; ``zero`` columns are 0 there.

    ``time`` holds whole steps, each once. Each row makes the steps up to the row after it, which may lie in the next block.
    """
    step_of = F.expr(f"interval {step}")
    following = over_blocks(
        series, [F.col(time).asc()], lambda w: {"_next": F.lead(time).over(w)}, after=1, name="gaps"
    )
    until = F.coalesce(F.col("_next") - step_of, F.col(time))
    made = following.withColumn("_time", F.explode(F.sequence(F.col(time), until, step_of)))
    own = F.col("_time") == F.col(time)
    others = [c for c in series.columns if c != time]
    return made.select(
        F.col("_time").alias(time),
        *[F.when(own, F.col(c)).otherwise(F.lit(0) if c in zero else F.lit(None)).alias(c) for c in others],
    )


def exponential_levels(daily: DataFrame, series_keys: Sequence[str] = (), alpha: float = 0.3) -> DataFrame:
    """The level of simple exponential smoothing after the last day of each series, and its weekday factors.

    Each day's revenue is divided by its weekday's factor (days whose factor is zero or unknown count as they are); the
    first day starts the level, and every later one moves it by ``alpha`` of its distance. The recursion depends on the
    order, so it is folded over the days of a series in one expression; a series has one entry a day.
    """
    factors = series_levels(daily, series_keys).select(*series_keys, "last_date", "weekday_factors")
    factor = F.element_at("weekday_factors", F.col("day_of_week"))
    base = F.when(factor > 0, F.col("revenue") / factor).otherwise(F.col("revenue"))
    days = daily.where(F.col("order_date").isNotNull() & F.col("revenue").isNotNull())
    known = days.join(factors, list(series_keys)) if series_keys else days.crossJoin(F.broadcast(factors))
    entries = F.array_sort(F.collect_list(F.struct("order_date", base.alias("x"))))
    level = F.aggregate(
        F.slice("_days", 2, F.greatest(F.size("_days") - 1, F.lit(0))),
        F.col("_days")[0]["x"],
        lambda at, day: F.lit(alpha) * day["x"] + F.lit(1 - alpha) * at,
    )
    return (
        known.groupBy(*series_keys, "last_date", "weekday_factors")
        .agg(entries.alias("_days"))
        .withColumn("level", level)
        .drop("_days")
    )


def weighted_moving_average(
    daily: DataFrame, series_keys: Sequence[str] = (), rows: int = WEEK
) -> DataFrame:
    """Trailing mean with weights ``rows`` (newest) down to 1, normalised over the rows present."""
    by_date = _by_date(series_keys)
    total, weight = F.lit(0.0), F.lit(0.0)
    for age in range(rows):
        value = F.lag("revenue", age).over(by_date)
        total = total + F.coalesce(value * F.lit(float(rows - age)), F.lit(0.0))
        weight = weight + F.when(value.isNotNull(), F.lit(float(rows - age))).otherwise(F.lit(0.0))
    return daily.withColumn(f"weighted_ma_{rows}", F.try_divide(total, weight))


def weekday_seasonality(
    daily: DataFrame, series_keys: Sequence[str] = (), created_at: Column | None = None
) -> DataFrame:
    """Mean, sample deviation and number of days per weekday, and its factor to the overall mean.

    The overall mean is a mean of days. It comes from the (at most eight) weekday rows of a series,
    so the daily frame is read once.
    """
    weekdays = daily.groupBy(*series_keys, "day_of_week", "day_name").agg(
        money_mean("revenue").alias("avg_revenue"),
        F.stddev_samp("revenue").alias("stddev_revenue"),
        F.count("order_date").alias("sample_count"),
        money_sum("revenue").alias("_revenue"),
        F.count("revenue").alias("_days"),
    )
    series = Window.partitionBy(*series_keys)
    overall = F.try_divide(money_sum("_revenue", series), F.sum("_days").over(series))
    weekdays = weekdays.withColumn(
        "seasonality_factor", F.try_divide(F.col("avg_revenue"), overall)
    ).drop("_revenue", "_days")
    return weekdays if created_at is None else weekdays.withColumn("created_at", created_at)


def overall_daily_mean(daily: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Mean revenue of the days of each series."""
    return daily.groupBy(*series_keys).agg(money_mean("revenue").alias("overall_avg"))


def _positioned(daily: DataFrame, series_keys: Sequence[str]) -> DataFrame:
    return daily.withColumns(
        {
            "_row": F.row_number().over(_by_date(series_keys)),
            "_rows": F.count(F.lit(1)).over(Window.partitionBy(*series_keys)),
        }
    )


def first_and_last_days(
    daily: DataFrame, series_keys: Sequence[str] = (), n: int = WEEK
) -> DataFrame:
    """The first and the last ``n`` dates of each series, marked."""
    placed = _positioned(daily, series_keys)
    return (
        placed.withColumn("is_first", F.col("_row") <= n)
        .withColumn("is_last", F.col("_row") > F.col("_rows") - n)
        .filter("is_first OR is_last")
        .drop("_row", "_rows")
    )


def series_levels(daily: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """One row per series with all a forecast needs, from one pass over the daily frame.

    overall_avg, recent_avg (last 7 rows), first_avg (first 7 rows), ma_7 and ma_14 of the newest
    row (so ma_7 is recent_avg, and no moving frame has to be evaluated), growth_rate (last 7 rows against the first 7 of the whole history, 0 where those are not
    positive), last_date, and ``weekday_factors``, an array indexed by weekday number with null for
    weekdays never seen. A series without a dated row gives no row.
    """
    from_end = F.col("_rows") - F.col("_row")

    def mean_where(condition: Column) -> Column:
        return money_mean(F.when(condition, F.col("revenue")))

    levels = _positioned(daily, series_keys).groupBy(*series_keys).agg(
        money_mean("revenue").alias("overall_avg"),
        mean_where(from_end < WEEK).alias("recent_avg"),
        mean_where(F.col("_row") <= WEEK).alias("first_avg"),
        mean_where(from_end < 2 * WEEK).alias("ma_14"),
        F.max("order_date").alias("last_date"),
        F.array(
            *(mean_where(F.col("day_of_week") == number) for number in range(1, WEEK + 1))
        ).alias("_weekday_avg"),
    )
    factors = F.transform("_weekday_avg", lambda mean: F.try_divide(mean, F.col("overall_avg")))
    return (
        levels.filter(F.col("last_date").isNotNull())
        .withColumns(
            {
                "ma_7": F.col("recent_avg"),
                "growth_rate": growth(F.col("recent_avg"), F.col("first_avg")),
                "weekday_factors": factors,
            }
        )
        .drop("_weekday_avg")
    )


def week_over_week(daily: DataFrame, series_keys: Sequence[str] = ()) -> DataFrame:
    """Mean of the last 7 rows, of the 7 rows before them, and the growth between the two."""
    from_end = F.col("_rows") - F.col("_row")
    weeks = _positioned(daily, series_keys).groupBy(*series_keys).agg(
        money_mean(F.when(from_end < WEEK, F.col("revenue"))).alias("this_week_avg"),
        money_mean(
            F.when((from_end >= WEEK) & (from_end < 2 * WEEK), F.col("revenue"))
        ).alias("previous_week_avg"),
    )
    return weeks.withColumn(
        "wow_growth_rate", growth(F.col("this_week_avg"), F.col("previous_week_avg"))
    )
