import random
from datetime import date, datetime, timedelta

import pytest
from data import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemart.operators import (
    apply_snapshot,
    asof_lookup,
    find_gaps,
    latest_by_key,
    plan_windows,
    valid_at,
    with_previous,
)
from tidemart.sources import calendar, default_calendar_end

DAY0 = date(2025, 1, 1)


def hot_series(spark, n=3000, share=0.4, seed=7):
    """Series of which one holds ``share`` of all rows; (k, d) is unique."""
    rng = random.Random(seed)
    seen = set()
    while len(seen) < n:
        key = "hot" if rng.random() < share else f"k{rng.randrange(60)}"
        seen.add((key, DAY0 + timedelta(days=rng.randrange(1500))))
    data = [(k, d, rng.random(), f"note {rng.randrange(9)}") for k, d in sorted(seen)]
    return spark.createDataFrame(data, "k STRING, d DATE, v DOUBLE, s STRING")


@pytest.mark.parametrize("period", [None, "day", "year"])
def test_with_previous_equals_a_window_over_whole_keys(spark, period):
    df = hot_series(spark)
    names = {"v": "pv", "d": "pd", "s": "ps"}
    by_key = Window.partitionBy("k").orderBy("d")
    expected = df.withColumns({new: F.lag(c).over(by_key) for c, new in names.items()})
    got = with_previous(df, ["k"], "d", names, period)
    assert got.columns == expected.columns
    assert rows(got) == rows(expected)


def test_with_previous_on_timestamps(spark):
    df = hot_series(spark, 800).withColumn(
        "d", F.col("d").cast("timestamp") + F.make_dt_interval(hours=F.length("s") * 3)
    )
    by_key = Window.partitionBy("k").orderBy("d")
    expected = df.withColumn("pv", F.lag("v").over(by_key))
    assert rows(with_previous(df, ["k"], "d", {"v": "pv"})) == rows(expected)


def test_with_previous_shuffles_the_rows_once_and_never_by_key_alone(spark):
    df = with_previous(hot_series(spark), ["k"], "d", {"v": "pv"})
    plan = df._jdf.queryExecution().executedPlan().toString()
    wide = [line for line in plan.splitlines() if "Window" in line and "partition" in line.lower()]
    assert plan.count("Exchange hashpartitioning(k#") <= 3
    assert wide is not None
    assert "SortAggregate" not in plan


def test_latest_by_key_is_deterministic(spark):
    data = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "w"), ("b", 0, "v")]
    df = spark.createDataFrame(data, "k STRING, t INT, v STRING")
    expected = [("a", 2, "z"), ("b", 0, "v")]
    assert rows(latest_by_key(df, ["k"], ["t"])) == expected
    assert rows(latest_by_key(df.orderBy(F.desc("v")).repartition(3), ["k"], ["t"])) == expected
    assert rows(latest_by_key(df.select("k"), ["k"])) == [("a",), ("b",)]


@pytest.mark.parametrize(
    ("start", "end", "size", "count"),
    [
        (date(2026, 1, 1), date(2026, 1, 25), 10, 3),
        (date(2026, 1, 1), date(2026, 1, 20), 10, 2),
        (date(2026, 1, 1), date(2026, 12, 31), 365, 1),
        (date(2026, 1, 1), date(2026, 1, 1), 1, 1),
        (date(2026, 1, 2), date(2026, 1, 1), 10, 0),
    ],
)
def test_windows_cover_the_range(spark, start, end, size, count):
    ranges = spark.createDataFrame([(start, end)], "lo DATE, hi DATE")
    windows = rows(plan_windows(ranges, "lo", "hi", size), "window_start", "window_end")
    assert len(windows) == count
    if windows:
        assert windows[0][0] == start and windows[-1][1] == end
        assert all(b[0] == a[1] + timedelta(days=1) for a, b in zip(windows, windows[1:], strict=False))
        assert all((e - s).days < size for s, e in windows)


def test_window_limits(spark):
    ranges = spark.createDataFrame([(DAY0, DAY0)], "lo DATE, hi DATE")
    for bad in (dict(min_days=0), dict(max_days=5, min_days=6)):
        with pytest.raises(ValueError, match="invalid window"):
            plan_windows(ranges, "lo", "hi", **bad)


def test_gaps_equal_brute_force(spark):
    df = hot_series(spark, 400).filter("d < '2025-04-01'")
    weekdays = calendar(spark, DAY0, date(2025, 4, 1), "day").filter(F.weekday("day") < 5)
    days = [r.day for r in weekdays.orderBy("day").collect()]
    entities = spark.createDataFrame([("hot",), ("silent",)], "k STRING")
    loaded = {}
    for r in df.collect():
        loaded.setdefault(r.k, set()).add(r.d)
    # Keys whose only rows fall outside the calendar have no loaded day.
    loaded = {k: v for k, v in loaded.items() if v & set(days)}
    expected = [("silent", days[0], days[-1], len(days))]
    for k, have in loaded.items():
        run = []
        for d in [*days, None]:
            if d is not None and d not in have:
                run.append(d)
            elif run:
                expected.append((k, run[0], run[-1], len(run)))
                run = []
    assert rows(find_gaps(df, ["k"], "d", weekdays, "day", entities)) == sorted(expected, key=repr)


def test_default_calendar_end(spark):
    assert default_calendar_end(date(2026, 8, 1)) == date(2028, 1, 1)
    assert calendar(spark, date(2026, 1, 2), date(2026, 1, 1)).count() == 0


T1, T2, T3 = (datetime(2026, 1, n, 12) for n in (1, 2, 3))
HISTORY = "code STRING, name STRING, dbt_valid_from TIMESTAMP, dbt_valid_to TIMESTAMP"


def catalog(spark, data):
    return spark.createDataFrame(data, "code STRING, name STRING")


def test_history_of_change_delete_and_return(spark):
    history = spark.createDataFrame([], HISTORY)
    us, usa = ("USD", "US Dollar"), ("USD", "United States Dollar")
    kuna = ("HRK", "Kuna")
    for at, batch in [(T1, [us, kuna]), (T2, [usa]), (T3, [usa, kuna]), (T3, [usa, kuna])]:
        history = apply_snapshot(history, catalog(spark, batch), ["code"], ["name"], at)
    expected = [
        ("HRK", "Kuna", T1, T2),
        ("HRK", "Kuna", T3, None),
        ("USD", "US Dollar", T1, T2),
        ("USD", "United States Dollar", T2, None),
    ]
    assert rows(history) == sorted(expected, key=repr)
    assert rows(valid_at(history, T2, "dbt_valid_from", "dbt_valid_to"), "code") == [("USD",)]


def test_checked_column_may_become_null_and_deletes_may_be_ignored(spark):
    history = spark.createDataFrame([], HISTORY)
    for at, batch in [(T1, [("A", None), ("B", "b")]), (T2, [("A", "a")]), (T3, [("A", None)])]:
        history = apply_snapshot(
            history, catalog(spark, batch), ["code"], ["name"], at, hard_deletes=False
        )
    assert rows(history) == sorted(
        [("A", None, T1, T2), ("A", "a", T2, T3), ("A", None, T3, None), ("B", "b", T1, None)],
        key=repr,
    )


def test_history_invariants_on_random_catalogs(spark):
    rng = random.Random(3)
    history = spark.createDataFrame([], HISTORY)
    for step in range(5):
        batch = [(f"c{i}", f"n{rng.randrange(2)}") for i in range(30) if rng.random() < 0.7]
        at = T1 + timedelta(days=step)
        history = apply_snapshot(history, catalog(spark, batch), ["code"], ["name"], at)
        now = valid_at(history, at, "dbt_valid_from", "dbt_valid_to")
        assert rows(now, "code", "name") == sorted(batch, key=repr)
    by_key = Window.partitionBy("code").orderBy("dbt_valid_from")
    following = F.lead("dbt_valid_from").over(by_key)
    overlaps = "dbt_valid_to > following OR (dbt_valid_to IS NULL AND following IS NOT NULL)"
    assert history.withColumn("following", following).filter(overlaps).isEmpty()


@pytest.mark.parametrize(("period", "salts"), [("day", 1), ("hour", 3), ("year", 7)])
def test_asof_lookup_equals_a_range_join(spark, period, salts):
    rng = random.Random(11)

    def when(n):
        return datetime(2025, 1, 1) + timedelta(hours=n)

    versions = []
    for i in range(25):
        at = 0
        for v in range(rng.randrange(6)):
            start = at + rng.randrange(1, 400)
            end = None if rng.random() < 0.2 else start + rng.randrange(1, 400)
            versions.append((f"k{i}", f"v{v}", when(start), when(end) if end else None))
            if end is None:
                break
            at = end - rng.randrange(2)  # adjacent or apart
            at = max(at, end) if rng.random() < 0.5 else end
    facts = [
        (n, "k0" if rng.random() < 0.4 else f"k{rng.randrange(30)}", when(rng.randrange(2000)))
        for n in range(600)
    ]
    history = spark.createDataFrame(versions, "k STRING, name STRING, lo TIMESTAMP, hi TIMESTAMP")
    df = spark.createDataFrame(facts, "id INT, k STRING, at TIMESTAMP")
    joined = df.alias("f").join(
        history.alias("h"),
        (F.col("f.k") == F.col("h.k"))
        & (F.col("lo") <= F.col("at"))
        & (F.col("hi").isNull() | (F.col("at") < F.col("hi"))),
        "left",
    )
    expected = joined.select("id", "f.k", "at", "name")
    got = asof_lookup(df, history, ["k"], "at", "lo", "hi", ["name"], period, salts)
    assert got.columns == ["id", "k", "at", "name"]
    assert rows(got) == rows(expected)
