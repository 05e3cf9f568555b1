"""Seeds: small versioned reference tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_seed(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with a header and declared types (codes keep their leading zeros)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


CURRENCY_REGION_SCHEMA = "codigo_moneda STRING, nombre_alternativo STRING, region STRING"

# Spanish name and region per currency code; must equal the reference's seed
# (fixed values).
CURRENCY_REGION = """
ARS,Peso Argentino,América
AUD,Dólar Australiano,Oceanía
BGN,Lev Búlgaro,Europa
BRL,Real Brasileño,América
CAD,Dólar Canadiense,América
CHF,Franco Suizo,Europa
CNY,Yuan Chino,Asia
CYP,Libra Chipriota,Europa
CZK,Corona Checa,Europa
DKK,Corona Danesa,Europa
DZD,Dinar Argelino,África
EEK,Corona Estonia,Europa
EUR,Euro,Europa
GBP,Libra Esterlina,Europa
GRD,Dracma Griego,Europa
HKD,Dólar de Hong Kong,Asia
HRK,Kuna Croata,Europa
HUF,Florín Húngaro,Europa
IDR,Rupia Indonesia,Asia
ILS,Nuevo Séquel Israelí,Asia
INR,Rupia India,Asia
ISK,Corona Islandesa,Europa
JPY,Yen Japonés,Asia
KRW,Won Surcoreano,Asia
LTL,Litas Lituana,Europa
LVL,Lats Letón,Europa
MAD,Dírham Marroquí,África
MTL,Lira Maltesa,Europa
MXN,Peso Mexicano,América
MYR,Ringgit Malayo,Asia
NOK,Corona Noruega,Europa
NZD,Dólar Neozelandés,Oceanía
PHP,Peso Filipino,Asia
PLN,Zloty Polaco,Europa
ROL,Leu Rumano (viejo),Europa
RON,Leu Rumano,Europa
RUB,Rublo Ruso,Europa
SEK,Corona Sueca,Europa
SGD,Dólar de Singapur,Asia
SIT,Tólar Esloveno,Europa
SKK,Corona Eslovaca,Europa
THB,Baht Tailandés,Asia
TRL,Lira Turca (vieja),Asia
TRY,Lira Turca,Asia
TWD,Nuevo Dólar Taiwanés,Asia
USD,Dólar Estadounidense,América
ZAR,Rand Sudafricano,África
"""


def currency_region_seed(spark: SparkSession) -> DataFrame:
    rows = [tuple(line.split(",")) for line in CURRENCY_REGION.split("\n") if line]
    return spark.createDataFrame(rows, CURRENCY_REGION_SCHEMA)
