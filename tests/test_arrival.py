"""Order of arrival, rows turned away, files opened, months read, streams cut off."""

import json
import os
from datetime import date, timedelta

import pytest
from data import rows

from tidemart.loads import landing_manifest, load_incremental, load_merge
from tidemart.operators import latest_by_key
from tidemart.plans import load_catalog, load_rates, reconcile_rates
from tidemart.sources import read_quote_payloads
from tidemart.specs import ARRIVAL, TableSpec, catalog_spec, declared_tables, rates_spec
from tidemart.streaming import merge as stream
from tidemart.streaming import stream_merge

SPEC = rates_spec("fx")
SINCE = date(2026, 1, 1)


def land(folder, name, quotes, at, **more):
    """One reply that landed ``at`` seconds after some time."""
    folder.mkdir(exist_ok=True)
    file = folder / name
    file.write_text(json.dumps({"amount": 1.0, "base": "EUR", "rates": quotes, **more}))
    os.utime(file, (1_700_000_000 + at, 1_700_000_000 + at))


def quotes(wh):
    return {(str(r.date), r.currency): float(r.rate) for r in wh.read("raw", SPEC.name).collect()}


def log(wh, spec=SPEC):
    return [
        (r.n_read, r.n_rows, r.n_dropped) for r in wh.log(spec.layer, spec.name).orderBy("seq").collect()
    ]


# -- order of arrival ------------------------------------------------------------


def test_the_later_file_holds_whatever_its_name_and_rate(spark, warehouse, tmp_path):
    land(tmp_path / "in", "b.json", {"2026-01-02": {"USD": 1.2, "BRL": 6.0}}, at=0)
    land(tmp_path / "in", "a.json", {"2026-01-02": {"USD": 1.1}}, at=60)
    load_rates(warehouse, "fx", str(tmp_path / "in"), "EUR", initial=SINCE)
    assert quotes(warehouse) == {("2026-01-02", "USD"): 1.1, ("2026-01-02", "BRL"): 6.0}
    assert log(warehouse) == [(3, 2, 0)]
    assert ARRIVAL not in warehouse.read("raw", SPEC.name).columns


def test_fetched_at_comes_before_the_file_time(warehouse, tmp_path):
    day = {"2026-01-02": {"USD": 1.2}}
    land(tmp_path / "in", "copied.json", day, at=60, fetched_at="2026-01-03T08:00:00Z")
    land(tmp_path / "in", "first.json", {"2026-01-02": {"USD": 1.1}}, at=0, fetched_at="2026-01-04T08:00:00Z")
    load_rates(warehouse, "fx", str(tmp_path / "in"), "EUR", initial=SINCE)
    assert quotes(warehouse) == {("2026-01-02", "USD"): 1.1}


def test_the_later_line_of_a_file_holds(spark, warehouse, tmp_path):
    lines = [{"date": "2026-01-02", "rates": {"USD": r}} for r in (3.0, 9.0, 1.5)]
    (tmp_path / "in.json").write_text("\n".join(map(json.dumps, lines)))
    df = read_quote_payloads(spark, str(tmp_path / "in.json"), "EUR", in_order=True)
    load_merge(warehouse, df, SPEC.__class__("r", ("date", "currency"), "date"))
    assert [float(r.rate) for r in warehouse.read("raw", "r").collect()] == [1.5]


def test_last_row_of_a_key_ships_each_column_once(spark):
    df = spark.createDataFrame([("a", 1, "x", 2.0)], "k STRING, t INT, v STRING, w DOUBLE")
    plan = latest_by_key(df, ["k"], ["t"])._jdf.queryExecution().optimizedPlan().toString()
    assert "max_by" not in plan and plan.count("max(struct(") == 1
    # Maps can't be compared: only they need a rank beside the row.
    mapped = spark.sql("SELECT 'a' k, map('x', t) m, t FROM VALUES (1), (3), (2) AS t(t)")
    assert latest_by_key(mapped, ["k"], ["t"]).first().m == {"x": 3}


# -- rows turned away --------------------------------------------------------------


def test_rows_without_key_cursor_or_rate_are_counted_and_kept(warehouse, tmp_path):
    land(tmp_path / "in", "a.json", {"2026-01-02": {"USD": 1.2, "BRL": None}, "2025-12-31": {"USD": 3}}, 0)
    (tmp_path / "in" / "b.json").write_text(json.dumps({"rates": {"GBP": 2.0}}))  # no date anywhere
    load_rates(warehouse, "fx", str(tmp_path / "in"), "EUR", initial=SINCE)
    assert quotes(warehouse) == {("2026-01-02", "USD"): 1.2}
    assert log(warehouse) == [(4, 1, 3)]
    kept = warehouse.read("rejects", SPEC.name)
    assert rows(kept, "currency", "reject_reason") == [
        ("BRL", "null rate"),
        ("GBP", "null date"),
        ("USD", "before the window"),
    ]
    load_id = warehouse.log("raw", SPEC.name).first().load_id
    assert {r.reject_load_id for r in kept.collect()} == {load_id}
    assert sorted(r._file[-6:] for r in kept.collect()) == ["a.json", "a.json", "b.json"]


def test_null_cursors_are_not_lost(spark, warehouse):
    spec = TableSpec("t", ("k", "d"), cursor="d")
    batch = spark.createDataFrame([(1, date(2026, 1, 5)), (2, None), (3, None)], "k INT, d DATE")
    load_incremental(warehouse, spec, lambda _: batch, initial=SINCE)
    assert log(warehouse, spec) == [(3, 1, 2)]
    assert warehouse.read("rejects", "t").count() == 2


def test_a_batch_without_rows_is_a_load_of_nothing(spark, warehouse):
    spec = TableSpec("t", ("k", "d"), cursor="d")
    batch = spark.createDataFrame([(1, date(2026, 1, 5))], "k INT, d DATE")
    for rows_ in (batch.limit(0), batch, batch.filter("k > 1"), spark.createDataFrame([], batch.schema)):
        load_incremental(warehouse, spec, lambda _, df=rows_: df, initial=SINCE)
    assert log(warehouse, spec) == [(0, 0, 0), (1, 1, 0), (0, 0, 0), (0, 0, 0)]
    assert warehouse.read("raw", "t").count() == 1
    assert not warehouse.exists("rejects", "t")


def test_catalog_without_names(warehouse, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"USD": "Dollar", "XXX": None}))
    load_catalog(warehouse, "fx", str(tmp_path))
    spec = catalog_spec("fx")
    assert rows(warehouse.read("raw", spec.name), "code") == [("USD",)]
    assert rows(warehouse.read("rejects", spec.name), "code", "reject_reason") == [("XXX", "null name")]


def test_declared_tables_say_how_they_load():
    assert [(s.name[7:], s.disposition, s.not_null) for s in declared_tables("fx")] == [
        ("exchange_rates", "merge", ("date", "base", "currency", "rate")),
        ("currencies", "replace", ("code", "name")),
    ]
    with pytest.raises(ValueError, match="disposition"):
        TableSpec("t", ("k",), disposition="upsert")


# -- files and months opened ---------------------------------------------------------


def spoil(file):
    """Makes a file unreadable without a change of its time or size."""
    before = file.stat()
    file.write_text("!" * before.st_size)
    os.utime(file, (before.st_atime, before.st_mtime))


def test_daily_load_opens_new_files_and_those_of_the_window(warehouse, tmp_path):
    folder = tmp_path / "in"
    land(folder, "old.json", {"2026-01-05": {"USD": 1.0}, "2026-01-09": {"USD": 2.0}}, 0)
    land(folder, "late.json", {"2026-02-10": {"USD": 3.0}}, 1)
    land(folder, "none.json", {}, 2)
    load_rates(warehouse, "fx", str(folder), "EUR", initial=SINCE)
    files = landing_manifest(warehouse, SPEC).collect()
    held = {r.file[-8:]: (str(r.first_at), str(r.last_at), r.n_rows) for r in files}
    assert held == {
        "old.json": ("2026-01-05", "2026-01-09", 2),
        "ate.json": ("2026-02-10", "2026-02-10", 1),
        "one.json": ("None", "None", 0),
    }
    spoil(folder / "old.json")
    spoil(folder / "none.json")
    land(folder, "new.json", {"2026-02-11": {"USD": 4.0}, "2026-01-05": {"USD": 9.0}}, 3)
    load_rates(warehouse, "fx", str(folder), "EUR")
    assert quotes(warehouse)["2026-02-11", "USD"] == 4.0
    # late.json once more and new.json, of which one quote lies before the window.
    assert log(warehouse) == [(3, 3, 0), (3, 2, 1)]
    assert landing_manifest(warehouse, SPEC).count() == 4

    (folder / "old.json").unlink()
    reconcile_rates(warehouse, "fx", str(folder), "EUR")  # new.json has a date in its window
    assert quotes(warehouse)["2026-01-05", "USD"] == 9.0
    assert landing_manifest(warehouse, SPEC).count() == 4


def test_a_file_written_anew_is_new(warehouse, tmp_path):
    folder = tmp_path / "in"
    land(folder, "a.json", {"2026-01-05": {"USD": 1.0}}, 0)
    land(folder, "b.json", {"2026-03-05": {"USD": 1.0}}, 0)
    load_rates(warehouse, "fx", str(folder), "EUR", initial=SINCE)
    land(folder, "a.json", {"2026-03-04": {"USD": 2.0}}, 9)
    load_rates(warehouse, "fx", str(folder), "EUR")
    assert quotes(warehouse)["2026-03-04", "USD"] == 2.0


def test_more_files_than_names_are_read_as_a_whole(warehouse, tmp_path, monkeypatch):
    monkeypatch.setattr("tidemart.loads.manifest.MAX_PATHS", 1)
    folder = tmp_path / "in"
    land(folder, "a.json", {"2026-03-05": {"USD": 1.0}}, 0)
    load_rates(warehouse, "fx", str(folder), "EUR", initial=SINCE)
    for k in range(3):
        land(folder, f"n{k}.json", {f"2026-03-0{6 + k}": {"USD": 2.0}}, k)
    load_rates(warehouse, "fx", str(folder), "EUR")
    assert len(quotes(warehouse)) == 4 and landing_manifest(warehouse, SPEC).count() == 4


def test_a_day_of_forty_months_opens_one_folder(spark, warehouse):
    days = [(date(2023, 1, 1) + timedelta(days=5 * n), "EUR", "USD", 1.0) for n in range(240)]
    df = spark.createDataFrame(days, "date DATE, base STRING, currency STRING, rate DOUBLE")
    load_merge(warehouse, df, TableSpec(SPEC.name, SPEC.keys, SPEC.cursor))
    assert len(warehouse.state("raw", SPEC.name).folders) == 40
    day = days[100][0]
    one = warehouse.read_between("raw", SPEC.name, "date", day, day)
    assert {f.split("load_part=")[1][:6] for f in one.inputFiles()} == {f"{day:%Y%m}"}
    assert [r.date for r in one.collect()] == [day]
    assert "PushedFilters: [IsNotNull(date)" in one._jdf.queryExecution().executedPlan().toString()
    after = warehouse.read_between("raw", SPEC.name, "date", day)
    assert after.count() == 140


# -- pictures ---------------------------------------------------------------------------


def test_picture_in_part_files_is_whole(spark, warehouse, tmp_path):
    for n, count in enumerate((30, 20)):
        entry = spark.range(count).selectExpr(f"to_json(map(concat('C', id), 'name {n}')) AS value")
        entry.repartition(4).write.mode("append").text(str(tmp_path / "in"))
    load_catalog(warehouse, "fx", str(tmp_path / "in"))
    got = rows(warehouse.read("raw", catalog_spec("fx").name), "code", "name")
    assert got == sorted((f"C{k}", "name 1") for k in range(20))


def test_picture_in_a_folder_is_whole(warehouse, tmp_path):
    for n, names in enumerate((["a", "b"], ["c", "d"])):
        for k, name in enumerate(names):
            folder = tmp_path / "in" / f"day={n}"
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{name}.json").write_text(json.dumps({name.upper(): name}))
            os.utime(folder / f"{name}.json", (1_700_000_000 + 10 * n + k,) * 2)
    load_catalog(warehouse, "fx", str(tmp_path / "in"))
    assert rows(warehouse.read("raw", catalog_spec("fx").name), "code") == [("C",), ("D",)]


def test_pictures_of_one_time_are_an_error(warehouse, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps({name: name}))
        os.utime(tmp_path / f"{name}.json", (1_700_000_000,) * 2)
    with pytest.raises(Exception, match="same time"):
        load_catalog(warehouse, "fx", str(tmp_path))


# -- streams ---------------------------------------------------------------------------


def run(wh, tmp_path, landing):
    return stream_merge(
        wh,
        SPEC,
        landing=str(landing),
        checkpoint=str(tmp_path / "checkpoint"),
        base="EUR",
        source="fx",
        overlap_days=10,
        initial=SINCE,
        max_files_per_trigger=1,
    )


FILES = [
    ("a.json", {"2026-06-02": {"USD": 1.0}}),
    ("b.json", {"2026-02-10": {"USD": 2.0}, "2025-11-01": {"USD": 7.0}}),
    ("c.json", {"2026-06-02": {"USD": 0.5}, "2026-02-11": {"USD": 3.0}}),
]
WHOLE = {("2026-06-02", "USD"): 0.5, ("2026-02-10", "USD"): 2.0, ("2026-02-11", "USD"): 3.0}


@pytest.mark.parametrize("moment", ["before the merge", "after the merge"])
def test_a_run_cut_off_is_taken_up_with_its_window(warehouse, tmp_path, monkeypatch, moment):
    landing = tmp_path / "in"
    for k, (name, reply) in enumerate(FILES):
        land(landing, name, reply, k)
    real, calls = stream.load_intake, []

    def dies(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2 and moment == "before the merge":
            raise RuntimeError("killed")
        real(*args, **kwargs)
        if len(calls) == 2:
            raise RuntimeError("killed")

    monkeypatch.setattr(stream, "load_intake", dies)
    with pytest.raises(Exception, match="killed"):
        run(warehouse, tmp_path, landing)
    monkeypatch.setattr(stream, "load_intake", real)
    assert not stream.last_run(warehouse, str(tmp_path / "checkpoint")).done
    # The mark is in June by now; February's files still belong to the run's window.
    done = run(warehouse, tmp_path, landing)
    assert (done.run, done.start, done.done) == (1, SINCE, True)
    assert quotes(warehouse) == WHOLE
    assert sorted(log(warehouse)) == [(1, 1, 0), (2, 1, 1), (2, 2, 0)]  # no batch twice
    batches = [r.batch for r in warehouse.log("raw", SPEC.name).collect()]
    assert sorted(b.split("/")[1] for b in batches) == ["0", "1", "2"]

    land(landing, "d.json", {"2026-05-01": {"USD": 8.0}, "2026-05-25": {"USD": 6.0}}, 9)
    following = run(warehouse, tmp_path, landing)
    assert (following.run, following.start) == (2, date(2026, 5, 23))
    assert quotes(warehouse) == {**WHOLE, ("2026-05-25", "USD"): 6.0}
    late = warehouse.read("rejects", SPEC.name).filter("date > '2026-01-01'")
    assert rows(late, "reject_reason", "currency") == [("before the window", "USD")]


def test_stream_corrects_downwards(warehouse, tmp_path):
    land(tmp_path / "in", "b.json", {"2026-01-02": {"USD": 1.2}}, 0)
    land(tmp_path / "in", "a.json", {"2026-01-02": {"USD": 1.1}}, 5)
    run(warehouse, tmp_path, tmp_path / "in")
    assert quotes(warehouse) == {("2026-01-02", "USD"): 1.1}
