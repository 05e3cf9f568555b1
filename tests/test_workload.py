"""Every registered query equals its SQL on the smallest tables."""

import sys
from decimal import Decimal as D
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SF_DIR = "/root/testdata/sf0.001"
sys.path[:0] = [str(ROOT), str(ROOT / "scripts")]

from compare import compare, duck  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from tidemart.sources import read_quote_payloads  # noqa: E402
from workload import inputs  # noqa: E402
from workload.oracles import ORACLES  # noqa: E402
from workload.queries import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables not present")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    assert compare(spark, duck(SF_DIR), SF_DIR, name) == ""


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_decimals_too_large_for_their_type_keep_their_digits(spark, tmp_path):
    keys = range(8097, 8106)
    path = str(tmp_path / "customer.parquet")
    spark.range(keys.start, keys.stop).toDF("c_custkey").write.parquet(path)
    found = QUERIES["schema_evolution_decimals"](spark, str(tmp_path)).collect()
    assert sorted(r.c_custkey for r in found) == [*keys]
    share = {r.c_custkey: [v for v in r[1:] if v is not None] for r in found}
    assert share[8099] == [float(D("1.2345678912") * 8099)]
    assert share[8102] == [float(D("1.2345678912") * 8102)]  # over 9,999 before the point


def test_landed_replies_are_packed_and_quotes_shuffled_once(spark, tmp_path):
    quotes = inputs.daily_quotes(spark, SF_DIR)
    assert quotes._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    path = inputs.land_payloads(spark, quotes, str(tmp_path / "landing"), packing="gzip")
    assert {p.name.split(".", 1)[1] for p in Path(path).glob("part-*")} == {"txt.gz"}
    assert read_quote_payloads(spark, path, "EUR").count() == quotes.count()
