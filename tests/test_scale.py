"""Plans and results when one key holds a large share of the rows."""

import json
import random
from datetime import date, timedelta

import pytest
from data import SOURCE, raw_rates, rows
from pyspark.sql import functions as F

from tidemart import work_dir
from tidemart.loads import load_merge
from tidemart.operators import asof_lookup, latest_by_key, period_summary, relationships, with_previous
from tidemart.plans import daily_quotes, dim_date, fact_quotes, monthly_report, stage_quotes
from tidemart.plans.marts import month_closes
from tidemart.specs import rates_spec


def final_plan(df):
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Sets session options for one test."""
    saved = {}

    def set_all(**options):
        for key, value in options.items():
            name = key.replace("__", ".")
            saved.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_all
    for name, value in saved.items():
        spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def hourly(spark, n=20000, hot=0.5):
    """Half the rows belong to one key, with a row every few minutes."""
    return spark.range(n).select(
        F.when(F.rand(1) < hot, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.timestamp_seconds(F.lit(1.7e9) + F.col("id") * 300).alias("t"),
        F.col("id").cast("double").alias("v"),
    )


def test_hot_key_is_spread_over_buckets(spark):
    """The largest window group is a day of the hot key, not the hot key."""
    df = with_previous(hourly(spark), ["k"], "t", {"v": "p"})
    text = plan(df)
    assert "__bucket" in text
    assert text.count("Exchange hashpartitioning(k") == 3  # rows, bucket ends, keys of ends
    per_bucket = hourly(spark).groupBy("k", F.date_trunc("day", "t")).count().agg(F.max("count"))
    assert per_bucket.first()[0] < 300


def test_previous_value_crosses_many_empty_buckets(spark):
    data = [("a", date(2000, 1, 1), 1.0), ("a", date(2019, 7, 1), 2.0), ("b", date(2019, 7, 2), 3.0)]
    df = spark.createDataFrame(data, "k STRING, d DATE, v DOUBLE")
    got = with_previous(df, ["k"], "d", {"v": "p", "d": "pd"}).select("k", "v", "p", "pd")
    assert rows(got) == [
        ("a", 1.0, None, None),
        ("a", 2.0, 1.0, date(2000, 1, 1)),
        ("b", 3.0, None, None),
    ]


def test_asof_lookup_forms_no_pairs(spark):
    facts = hourly(spark)
    history = spark.sql(
        "SELECT k, v, from, lead(from) OVER (PARTITION BY k ORDER BY from) AS until FROM ("
        " SELECT 'hot' AS k, id AS v, timestamp_seconds(1.7e9 + id * 3000) AS from FROM range(2000))"
    )
    found = asof_lookup(facts.drop("v"), history, ["k"], "t", "from", "until", ["v"])
    assert "Join" not in plan(found)
    wrong = found.filter("k = 'hot'").filter("v <> floor((unix_seconds(t) - 1.7e9) / 3000)")
    assert wrong.isEmpty()
    assert found.filter("k <> 'hot' AND v IS NOT NULL").isEmpty()
    assert found.count() == facts.count()


def test_skewed_dimension_lookup_is_split_at_run_time(spark, conf):
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    n = 40000
    raw = spark.range(0, n, 1, 8).select(
        F.date_add(F.lit(date(2001, 1, 1)), (F.col("id") % 1000).cast("int")).alias("date"),
        F.lit("EUR").alias("base"),
        F.concat(F.lit("C"), (F.col("id") / 1000).cast("int")).alias("currency"),
        (F.col("id") + 1).cast("decimal(20,8)").alias("rate"),
        F.lit(1).cast("decimal(20,8)").alias("amount"),
        F.current_timestamp().alias("_ingested_at"),
        F.lit("s").alias("_source"),
    )
    codes = spark.range(100).select(F.concat(F.lit("C"), "id").alias("codigo_moneda"))
    dim = codes.union(spark.sql("SELECT 'EUR'")).withColumn("clave_moneda", F.md5("codigo_moneda"))
    fact = fact_quotes(daily_quotes(stage_quotes(raw)), dim_date(spark, end=date(2005, 1, 1)), dim)
    assert fact.count() == n
    assert "isSkew=true" in final_plan(fact) or "skewed" in final_plan(fact)


def test_fact_and_report_are_shuffled_once_and_the_same(spark, conf):
    """Dealt by month and share of the pairs, rows go from the window, or the groups, to the write."""
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    raw = raw_rates(spark).withColumn("date", F.explode(F.array("date", F.date_add("date", 40))))
    quotes = stage_quotes(raw)
    closes, dates = month_closes(quotes), dim_date(spark, end=date(2027, 1, 1))
    codes = quotes.select(F.explode(F.array("moneda_base", "moneda_cotizada")).alias("codigo_moneda"))
    dim = codes.distinct().withColumn("clave_moneda", F.md5("codigo_moneda"))
    before = fact_quotes(daily_quotes(quotes, closes), dates, dim)
    after = fact_quotes(daily_quotes(quotes, closes, 3), dates, dim, in_place=True)
    assert rows(after.select(*before.columns)) == rows(before)
    assert plan(after).count("Exchange hashpartitioning(__bucket") == 1
    assert "SortMergeJoin" not in plan(after)
    assert rows(monthly_report(before, dates, 3)) == rows(monthly_report(before, dates))
    assert plan(monthly_report(before, dates, 3)).count("Exchange hashpartitioning(anio_mes") == 1


def test_partial_aggregates_precede_every_shuffle(spark):
    df = hourly(spark)
    parent = spark.createDataFrame([("hot",)], "k STRING")
    for query in (
        latest_by_key(df, ["k"], ["t"]),
        period_summary(df, ["k"], "t", "v", "v"),
        relationships("k", parent, "k").violations(df),
    ):
        text = plan(query)
        assert "partial_" in text
    assert "SortAggregate" not in plan(period_summary(df, ["k"], "t", "v", "v"))


def test_scan_reads_only_what_the_operator_needs(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_rates(spark).write.parquet(path)
    staged = stage_quotes(spark.read.parquet(path))
    text = plan(daily_quotes(staged).select("fecha", "variacion_pct"))
    assert "GreaterThan(rate" in text
    assert "amount" not in text and "_source" not in text


def test_merge_of_a_small_batch_does_not_read_other_months(spark, warehouse):
    spec = rates_spec(SOURCE)
    days = [date(2024, 1, 1) + timedelta(days=n) for n in range(366)]
    all_days = spark.createDataFrame(
        [(d, "EUR", "USD", 1.0) for d in days], "date DATE, base STRING, currency STRING, rate DOUBLE"
    ).withColumn("_ingested_at", F.current_timestamp())
    load_merge(warehouse, all_days, spec)
    before = warehouse.state("raw", spec.name).folders
    load_merge(warehouse, all_days.filter("date = '2024-05-05'").withColumn("rate", F.lit(2.0)), spec)
    after = warehouse.state("raw", spec.name).folders
    assert {p for p in after if after[p] != before[p]} == {"202405"}
    assert warehouse.read("raw", spec.name).filter("rate = 2").count() == 1
    assert warehouse.read("raw", spec.name).count() == 366


def test_work_dir_is_under_the_shared_folder(spark):
    folder = work_dir(spark)
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir").rstrip("/") + "/tidemart/")
    assert folder != work_dir(spark)


def test_log_rows_are_one_line_each(spark, warehouse, tmp_path):
    load_merge(warehouse, raw_rates(spark), rates_spec(SOURCE))
    folder = tmp_path / "warehouse" / "load_log" / "raw" / rates_spec(SOURCE).name
    lines = [line for f in folder.glob("part-*") for line in f.read_text().splitlines()]
    entry = json.loads(lines[0])
    assert len(lines) == 1 and entry["cursor"] == "2026-01-06" and entry["n_rows"] == 9


def test_random_merges_equal_a_dictionary(spark, warehouse):
    rng = random.Random(5)
    spec = rates_spec(SOURCE)
    expected = {}
    for step in range(4):
        batch = {}
        for _ in range(60):
            day = date(2025, 1, 1) + timedelta(days=rng.randrange(90))
            batch[day, "EUR", f"c{rng.randrange(4)}"] = float(step * 100 + rng.randrange(100))
        expected.update(batch)
        data = [(*key, value) for key, value in batch.items()]
        df = spark.createDataFrame(data, "date DATE, base STRING, currency STRING, rate DOUBLE")
        load_merge(warehouse, df.withColumn("_ingested_at", F.current_timestamp()), spec)
    got = warehouse.read("raw", spec.name).select("date", "base", "currency", "rate")
    assert {tuple(r)[:3]: r.rate for r in got.collect()} == expected
