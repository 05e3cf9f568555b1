"""Date ranges: cutting them into windows, and finding the missing ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemart.specs import WINDOW_MAX_DAYS


def plan_windows(
    ranges: DataFrame,
    start: str,
    end: str,
    max_days: int = WINDOW_MAX_DAYS,
    min_days: int = 1,
) -> DataFrame:
    """Cuts each closed range into closed windows of at most ``max_days``.

    Windows neither overlap nor leave a gap. An inverted range has none.
    """
    if min_days < 1 or max_days < min_days:
        raise ValueError(f"invalid window: min={min_days} max={max_days}")
    starts = F.sequence(F.col(start), F.col(end), F.expr(f"INTERVAL {max_days} DAYS"))
    return (
        ranges.filter(F.col(start) <= F.col(end))
        .withColumn("window_start", F.explode(starts))
        .withColumn(
            "window_end",
            F.least(F.date_add("window_start", max_days - 1), F.col(end)),
        )
    )


def find_gaps(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    calendar: DataFrame,
    day: str,
    entities: DataFrame | None = None,
) -> DataFrame:
    """Ranges of calendar days without a row, per key.

    ``calendar`` lists the expected days, each once. Days are numbered along it,
    and a gap shows as a jump between the numbers of neighbouring loaded days;
    keys and calendar are never multiplied. Keys in ``entities`` without any
    loaded day are one gap as long as the calendar. Columns: keys,
    ``gap_start``, ``gap_end``, ``n_days`` (calendar days in the gap).
    """
    # Numbering takes one task over the calendar, which has 366 rows a year at most.
    along = Window.orderBy(day)
    numbered = calendar.select(
        F.col(day).alias("__day"),
        F.row_number().over(along).alias("__n"),
        F.lag(day).over(along).alias("__day_before"),
        F.lead(day).over(along).alias("__day_after"),
    )
    first_day = calendar.agg(F.min(day)).scalar()
    last_day = calendar.agg(F.max(day)).scalar()
    size = calendar.agg(F.count(day).cast("int")).scalar()

    def gap(start: Column, end: Column, n_days: Column) -> Column:
        return F.struct(start.alias("gap_start"), end.alias("gap_end"), n_days.alias("n_days"))

    # One row per key and loaded day, so a key has at most the calendar's rows.
    loaded = df.select(*keys, F.col(at).alias("__day")).distinct().join(numbered, "__day")
    by_key = Window.partitionBy(*keys).orderBy("__n")
    steps = loaded.withColumns(
        {
            "__previous": F.lag("__n", 1, 0).over(by_key),
            "__resumes": F.coalesce(F.lag("__day_after").over(by_key), first_day),
            "__is_last": F.lead("__n").over(by_key).isNull(),
        }
    )
    before = gap(
        F.col("__resumes"), F.col("__day_before"), F.col("__n") - F.col("__previous") - 1
    )
    after = gap(F.col("__day_after"), last_day, size - F.col("__n"))
    both = F.array(before, F.when(F.col("__is_last"), after))
    gaps = steps.select(*keys, F.inline(both)).filter(F.col("n_days") > 0)

    if entities is not None:
        silent = entities.select(*keys).distinct().join(
            loaded.select(*keys).distinct(), list(keys), "left_anti"
        )
        whole = (first_day.alias("gap_start"), last_day.alias("gap_end"), size.alias("n_days"))
        gaps = gaps.unionByName(silent.select(*keys, *whole))
    return gaps
