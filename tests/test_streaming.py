import json
from datetime import date

from tidemart.specs import rates_spec
from tidemart.streaming import stream_merge


def land(folder, name, quotes):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps({"amount": 1.0, "base": "EUR", "rates": quotes}))


def run(wh, tmp_path):
    stream_merge(
        wh,
        rates_spec("fx"),
        landing=str(tmp_path / "landing"),
        checkpoint=str(tmp_path / "checkpoint"),
        base="EUR",
        source="fx",
        overlap_days=30,
        initial=date(2026, 1, 1),
    )
    raw = wh.read("raw", rates_spec("fx").name)
    return {(str(r.date), r.currency): float(r.rate) for r in raw.collect()}


def test_files_are_merged_once_and_rows_beyond_the_overlap_are_counted(warehouse, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", {"2026-01-10": {"USD": 1.0}, "2026-02-10": {"USD": 2.0}})
    first = {("2026-01-10", "USD"): 1.0, ("2026-02-10", "USD"): 2.0}
    assert run(warehouse, tmp_path) == first
    assert run(warehouse, tmp_path) == first

    land(landing, "b.json", {"2026-01-10": {"USD": 99.0}, "2026-02-05": {"USD": 55.0}})
    assert run(warehouse, tmp_path) == {**first, ("2026-02-05", "USD"): 55.0}
    log = warehouse.log("raw", rates_spec("fx").name).orderBy("seq").collect()
    assert [(r.n_rows, r.n_dropped) for r in log] == [(2, 0), (1, 1)]


def test_batch_size_does_not_decide_what_is_late(warehouse, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.json", {"2026-06-02": {"USD": 1.0}})
    land(landing, "b.json", {"2026-02-10": {"USD": 2.0}})
    stream_merge(
        warehouse,
        rates_spec("fx"),
        landing=str(landing),
        checkpoint=str(tmp_path / "checkpoint"),
        base="EUR",
        source="fx",
        overlap_days=30,
        initial=date(2026, 1, 1),
        max_files_per_trigger=1,
    )
    assert warehouse.read("raw", rates_spec("fx").name).count() == 2
    log = warehouse.log("raw", rates_spec("fx").name).collect()
    assert sorted((r.n_rows, r.n_dropped) for r in log) == [(1, 0), (1, 0)]
