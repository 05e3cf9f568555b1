"""DuckDB SQL equivalent to each query, over the same tables."""

from __future__ import annotations

# Shared inputs, as in `inputs`.
_LINE_QUOTES = """
line_quotes AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS base,
         'S' || CAST(l_suppkey AS VARCHAR) AS currency,
         CAST(l_extendedprice AS DECIMAL(20,8)) AS rate
  FROM lineitem
)"""
_RATES = f"""{_LINE_QUOTES},
rates AS (
  SELECT date, base, currency, MAX(rate) AS rate FROM line_quotes GROUP BY 1, 2, 3
)"""
_DAILY_RATES = f"""{_RATES},
daily_rates AS (SELECT date, currency, MAX(rate) AS rate FROM rates GROUP BY 1, 2)"""
_DAILY_STEPS = """
lagged AS (
  SELECT date AS fecha, base AS moneda_base, currency AS moneda_cotizada,
         CAST(rate AS DOUBLE) AS x,
         CAST(LAG(rate) OVER w AS DOUBLE) AS p,
         LAG(date) OVER w AS fecha_anterior
  FROM rates WINDOW w AS (PARTITION BY base, currency ORDER BY date)
),
daily AS (
  SELECT fecha, moneda_base, moneda_cotizada, x AS cotizacion, p AS cotizacion_anterior,
         fecha_anterior, CAST(fecha - fecha_anterior AS INTEGER) AS dias_desde_anterior,
         ROUND(1.0 / x, 12) AS cotizacion_inversa,
         CASE WHEN p IS NOT NULL THEN ROUND(100 * (x - p) / p, 6) END AS variacion_pct
  FROM lagged
)"""
_DAILY = f"{_RATES}, {_DAILY_STEPS}"
_ACTIVITY = f"""{_RATES},
catalog AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code,
         CASE WHEN s_acctbal > 9000 THEN NULL ELSE s_name END AS name
  FROM supplier WHERE s_acctbal > 0
),
observed AS (
  SELECT currency AS code, MIN(date) AS first_day, MAX(date) AS last_day,
         COUNT(DISTINCT date) AS n_days
  FROM rates GROUP BY 1
),
bases AS (SELECT DISTINCT base AS code FROM rates),
universe AS (
  SELECT code FROM observed UNION SELECT code FROM bases UNION SELECT code FROM catalog
),
activity AS (
  SELECT u.code AS codigo_moneda, c.name AS nombre_moneda,
         o.first_day AS primera_fecha, o.last_day AS ultima_fecha,
         COALESCE(o.n_days, 0) AS cantidad_dias_cotizados,
         c.code IS NOT NULL AS es_vigente, b.code IS NOT NULL AS es_moneda_base
  FROM universe u
  LEFT JOIN observed o ON u.code = o.code
  LEFT JOIN catalog c ON u.code = c.code
  LEFT JOIN bases b ON u.code = b.code
)"""
_DIM = f"""{_ACTIVITY},
seed AS (
  SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code, UPPER(s_name) AS alt, r_name AS region
  FROM supplier
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  WHERE r_name <> 'ASIA'
),
dim AS (
  SELECT MD5(codigo_moneda) AS clave_moneda, codigo_moneda,
         COALESCE(nombre_moneda, alt, codigo_moneda) AS nombre_moneda,
         COALESCE(region, 'Sin clasificar') AS region, es_vigente, es_moneda_base,
         strftime(primera_fecha, '%Y-%m-%d') AS primera_fecha,
         strftime(ultima_fecha, '%Y-%m-%d') AS ultima_fecha,
         cantidad_dias_cotizados
  FROM activity LEFT JOIN seed ON codigo_moneda = seed.code
)"""
_FACT = f"""{_DIM},
{_DAILY_STEPS},
fact AS (
  SELECT CAST(strftime(d.fecha, '%Y%m%d') AS INTEGER) AS clave_fecha,
         b.clave_moneda AS clave_moneda_base, q.clave_moneda AS clave_moneda_cotizada,
         d.fecha, moneda_base, moneda_cotizada, cotizacion, cotizacion_inversa,
         cotizacion_anterior, variacion_pct, dias_desde_anterior
  FROM daily d
  JOIN dim b ON b.codigo_moneda = moneda_base
  JOIN dim q ON q.codigo_moneda = moneda_cotizada
  WHERE d.fecha < (SELECT DATE_TRUNC('year', MAX(date)) FROM line_quotes)
)"""
_MONTHLY = """
grouped AS (
  SELECT strftime(fecha, '%Y-%m') AS anio_mes,
         CAST(EXTRACT(year FROM fecha) AS INTEGER) AS anio,
         CAST(EXTRACT(month FROM fecha) AS INTEGER) AS mes, moneda_base, moneda_cotizada,
         COUNT(*) AS cantidad_dias_publicados,
         ROUND(AVG(cotizacion), 8) AS cotizacion_promedio,
         MIN(cotizacion) AS cotizacion_minima, MAX(cotizacion) AS cotizacion_maxima,
         ARG_MIN(cotizacion, fecha) AS cotizacion_apertura,
         ARG_MAX(cotizacion, fecha) AS cotizacion_cierre,
         ROUND(COALESCE(STDDEV_SAMP(variacion_pct), 0), 6) AS volatilidad_pct
  FROM fact GROUP BY 1, 2, 3, 4, 5)
SELECT *, ROUND(100 * (cotizacion_cierre - cotizacion_apertura) / cotizacion_apertura, 6)
          AS variacion_mensual_pct
FROM grouped"""
# The fact over all days, with the quotes of the last days of each February raised.
_RAISED_FACT = _FACT.replace(
    "MAX(rate) AS rate FROM line_quotes",
    """MAX(rate) + CASE WHEN month(date) = 2 AND date = last_day(date) THEN 1000 ELSE 0 END
    AS rate FROM line_quotes""",
).replace("WHERE d.fecha < (SELECT DATE_TRUNC('year', MAX(date)) FROM line_quotes)", "")
_STAMP = "'2026-01-07 12:00:00'"

_CALENDAR = """
  CAST(strftime(d, '%Y%m%d') AS INTEGER) AS clave_fecha,
  strftime(d, '%Y-%m-%d') AS fecha,
  CAST(EXTRACT(year FROM d) AS INTEGER) AS anio,
  CAST(EXTRACT(quarter FROM d) AS INTEGER) AS trimestre,
  CAST(EXTRACT(month FROM d) AS INTEGER) AS mes,
  CAST(EXTRACT(day FROM d) AS INTEGER) AS dia_del_mes,
  CAST(EXTRACT(isodow FROM d) AS INTEGER) AS dia_de_semana,
  CAST(EXTRACT(week FROM d) AS INTEGER) AS semana_iso,
  strftime(d, '%B') AS nombre_mes,
  strftime(d, '%A') AS nombre_dia,
  strftime(d, '%Y-%m') AS anio_mes,
  'T' || CAST(EXTRACT(quarter FROM d) AS VARCHAR) AS nombre_trimestre,
  EXTRACT(isodow FROM d) BETWEEN 1 AND 5 AS es_dia_habil,
  d = DATE_TRUNC('month', d) AS es_primer_dia_del_mes,
  d = LAST_DAY(d) AS es_ultimo_dia_del_mes,
  strftime(DATE_TRUNC('month', d), '%Y-%m-%d') AS primer_dia_del_mes,
  strftime(LAST_DAY(d), '%Y-%m-%d') AS ultimo_dia_del_mes"""

_ORDERS = """
orders_in AS (
  SELECT CAST(o_orderdate AS DATE) AS day, o_orderkey, o_custkey, o_orderstatus, o_totalprice
  FROM orders
)"""
_ORDER_ROW = "strftime(day, '%Y-%m-%d') AS o_orderdate, o_orderkey, o_custkey, o_orderstatus"


def _two_loads(second: str, keep_first: bool = True) -> str:
    """First years, then corrected orders wherever ``second`` holds."""
    first = "day <= DATE '1997-12-31'" if keep_first else "FALSE"
    return f"""WITH {_ORDERS},
    mark AS (SELECT MAX(day) AS hwm FROM orders_in WHERE day <= DATE '1997-12-31'),
    loaded AS (SELECT *, {second} AS is_second FROM orders_in, mark)
    SELECT {_ORDER_ROW},
           o_totalprice + CASE WHEN is_second THEN 1000 ELSE 0 END AS o_totalprice
    FROM loaded WHERE is_second OR {first}"""


_LINE_COLUMNS = "l_orderkey, l_linenumber, l_shipdate, l_suppkey, l_quantity, l_returnflag"
_LATEST = "l_shipdate DESC, l_suppkey DESC, l_quantity DESC, l_returnflag DESC"
_LINE_ROW = """l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate,
  l_suppkey, l_quantity, l_returnflag"""


def _latest(source: str) -> str:
    return f"""(
    SELECT * FROM (
      SELECT *, ROW_NUMBER() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY {_LATEST}) AS rn
      FROM {source}) WHERE rn = 1)"""


_T1, _T2, _T3 = "'1996-06-01 00:00:00'", "'1998-01-01 12:00:00'", "'2000-01-01 18:30:00'"
_RENAMED = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDERS' ELSE c_mktsegment END"


def _history(returned: bool, hard_deletes: bool = True) -> str:
    """Versions written out case by case: debtors leave at T2, one segment is renamed."""
    closes = "c_acctbal < 0 OR c_mktsegment = 'BUILDING'"
    if not hard_deletes:
        closes = "c_acctbal >= 0 AND c_mktsegment = 'BUILDING'"
    parts = [
        f"""SELECT c_custkey, c_mktsegment, {_T1} AS dbt_valid_from,
            CASE WHEN {closes} THEN {_T2} END AS dbt_valid_to FROM customer""",
        f"""SELECT c_custkey, 'BUILDERS', {_T2}, {_T3 if returned else "CAST(NULL AS VARCHAR)"}
            FROM customer WHERE c_acctbal >= 0 AND c_mktsegment = 'BUILDING'""",
    ]
    if returned:
        parts.append(
            f"""SELECT c_custkey, c_mktsegment, {_T3}, CAST(NULL AS VARCHAR)
            FROM customer WHERE c_acctbal < 0 OR c_mktsegment = 'BUILDING'"""
        )
    return " UNION ALL ".join(parts)


def _local(ts: str) -> str:
    return f"""strftime(timezone('America/Argentina/Buenos_Aires',
      timezone('UTC', CAST({ts} AS TIMESTAMP))), '%Y-%m-%d %H:%M:%S')"""


def _check(name: str, severity: str, count: str) -> str:
    bad = "failed" if severity == "error" else "degraded"
    return f"""SELECT '{name}' AS "check", '{severity}' AS severity, n AS n_violations,
      CASE WHEN n = 0 THEN 'ok' ELSE '{bad}' END AS status
      FROM (SELECT CAST({count} AS BIGINT) AS n)"""


def _profile(name: str, source: str, keys: str, cursor: str | None) -> str:
    lo, hi, nulls, problem = "NULL", "NULL", "NULL", "0"
    if cursor:
        lo, hi = f"strftime(MIN({cursor}), '%Y-%m-%d')", f"strftime(MAX({cursor}), '%Y-%m-%d')"
        nulls = f"COUNT(*) FILTER (WHERE {cursor} IS NULL)"
        problem = f"CASE WHEN {nulls} > 0 THEN 1 ELSE 0 END"
    repeated = f"""(SELECT COUNT(*) FROM
      (SELECT {keys} FROM {source} GROUP BY {keys} HAVING COUNT(*) > 1))"""
    return f"""SELECT '{name}' AS "table", FALSE AS is_missing, COUNT(*) AS n_rows,
      {repeated} AS n_duplicate_keys, CAST({lo} AS VARCHAR) AS cursor_min,
      CAST({hi} AS VARCHAR) AS cursor_max, CAST({nulls} AS BIGINT) AS n_null_cursors,
      CAST({problem} + CASE WHEN {repeated} > 0 THEN 1 ELSE 0 END AS INTEGER) AS n_problems
      FROM {source}"""


def _freshness(as_of: str, status: str) -> str:
    return f"""SELECT strftime(MAX(ts), '%Y-%m-%d %H:%M:%S') AS max_loaded_at,
      CAST(FLOOR(EPOCH(TIMESTAMP '{as_of}' - MAX(ts)) / 3600) AS BIGINT) AS age_hours,
      CASE WHEN TIMESTAMP '{as_of}' - MAX(ts) > INTERVAL 72 HOUR THEN 'error'
           WHEN TIMESTAMP '{as_of}' - MAX(ts) > INTERVAL 30 HOUR THEN 'warn'
           ELSE '{status}' END AS status FROM events"""


def _rows(condition: str) -> str:
    return f"(SELECT COUNT(*) FROM lineitem WHERE {condition})"


_IN_CREDIT = "(SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000)"
_REPEATED = """(SELECT COUNT(*) FROM (
  SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1))"""
_LATE_DAYS = """(SELECT COUNT(DISTINCT l_shipdate) FROM lineitem
  WHERE l_shipdate > DATE '2000-01-01')"""
_RULES = [
    ("not_null_l_orderkey", "error", _rows("l_orderkey IS NULL")),
    ("not_null_l_shipdate", "warn", _rows("l_shipdate IS NULL")),
    ("between_l_quantity", "warn", _rows("NOT l_quantity BETWEEN 1 AND 50")),
    ("between_l_discount", "warn", _rows("NOT l_discount BETWEEN 0 AND 0.05")),
    ("length_l_returnflag", "warn", _rows("LENGTH(l_returnflag) <> 1")),
    ("unique_combination_l_orderkey_l_linenumber", "error", _REPEATED),
    ("relationships_l_suppkey", "warn", _rows(f"l_suppkey NOT IN {_IN_CREDIT}")),
    ("no_future_l_shipdate", "warn", _LATE_DAYS),
    ("session_timezone", "warn", "0"),
    ("heavy_discount", "warn", _rows("l_discount * l_extendedprice > 9000")),
]


# The types a column comes with, one load after the other; the first is the column's own.
_KINDS = ("38,2", "18,8", "14,10")


def _share(part: int, kind: str) -> str:
    side = f"__v_decimal_{kind.replace(',', '_')}" if part else ""
    value = "c_custkey * CAST(1.2345678912 AS DECIMAL(11,10))"
    return f"""CASE WHEN c_custkey % 3 = {part}
                    THEN CAST(CAST({value} AS DECIMAL({kind})) AS DOUBLE) END AS share{side}"""


ORACLES: dict[str, str] = {
    "stage_messy_quotes": f"""WITH {_LINE_QUOTES}
        SELECT strftime(date, '%Y-%m-%d') AS fecha, UPPER(TRIM(' ' || LOWER(base))) AS moneda_base,
               UPPER(TRIM(LOWER(currency) || '  ')) AS moneda_cotizada,
               CAST(rate - 20000 AS DOUBLE) AS cotizacion, CAST(1 AS DOUBLE) AS monto_base,
               {_STAMP} AS cargado_en, 'tpch' AS origen_dato
        FROM line_quotes WHERE rate - 20000 > 0""",
    "stage_catalog_blank_to_null": f"""
        SELECT 'C' || CAST(c_custkey AS VARCHAR) AS codigo_moneda,
               CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS nombre_moneda,
               {_STAMP} AS cargado_en, 'tpch' AS origen_dato
        FROM customer""",
    "previous_publication": f"""WITH {_DAILY}
        SELECT * REPLACE (strftime(fecha, '%Y-%m-%d') AS fecha,
                          strftime(fecha_anterior, '%Y-%m-%d') AS fecha_anterior)
        FROM daily""",
    "calendar_attributes": f"""
        SELECT {_CALENDAR}, n_items
        FROM (SELECT CAST(l_shipdate AS DATE) AS d, COUNT(*) AS n_items FROM lineitem GROUP BY 1)""",
    "calendar_days_without_rows": """
        SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS clave_fecha, COALESCE(n, 0) AS n_items
        FROM (SELECT CAST(UNNEST(generate_series(DATE '1994-01-01', DATE '2002-12-31',
                                                 INTERVAL 1 DAY)) AS DATE) AS d) days
        LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS day, COUNT(*) AS n FROM lineitem GROUP BY 1) i
          ON d = day""",
    "entity_activity": f"""WITH {_ACTIVITY}
        SELECT * REPLACE (strftime(primera_fecha, '%Y-%m-%d') AS primera_fecha,
                          strftime(ultima_fecha, '%Y-%m-%d') AS ultima_fecha)
        FROM activity""",
    "dim_entity_seed_default": f"WITH {_DIM} SELECT * FROM dim",
    "fact_star": f"""WITH {_FACT}
        SELECT * REPLACE (strftime(fecha, '%Y-%m-%d') AS fecha),
               {_STAMP} AS cargado_en, 'tpch' AS origen_dato
        FROM fact""",
    "monthly_quote_report": f"""WITH {_FACT}, {_MONTHLY}""",
    "incremental_mart_refresh": f"WITH {_RAISED_FACT}, {_MONTHLY}",
    "landed_files_to_report": f"""WITH {_LINE_QUOTES},
        rates AS (
          SELECT date, 'EUR' AS base, currency, MAX(rate) AS rate FROM line_quotes
          GROUP BY 1, 2, 3),
        {_DAILY_STEPS}, fact AS (SELECT * FROM daily), {_MONTHLY}""",
    "flatten_payload": f"""WITH {_LINE_QUOTES}
        SELECT strftime(date, '%Y-%m-%d') AS date, 'EUR' AS base, currency,
               CAST(rate AS DOUBLE) AS rate,
               CAST(CASE WHEN base = 'A' THEN 100 ELSE 1 END AS DOUBLE) AS amount
        FROM line_quotes""",
    "catalog_payload": "SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS name FROM customer",
    "seed_leading_zeros": """
        SELECT LPAD(CAST(c_custkey AS VARCHAR), 12, '0') AS code, c_name, c_mktsegment AS region
        FROM customer""",
    "row_metadata": f"""
        SELECT o_orderkey, o_custkey, {_STAMP} AS _ingested_at, 'tpch.orders' AS _source
        FROM orders""",
    "row_id_sha256": f"""WITH {_ORDERS}
        SELECT o_orderkey, o_custkey, strftime(day, '%Y-%m-%d') AS o_orderdate,
               NULLIF(o_orderstatus, 'P') AS status,
               SHA256(CAST(o_custkey AS VARCHAR) || '|' || COALESCE(NULLIF(o_orderstatus, 'P'), '')
                      || '|' || strftime(day, '%Y-%m-%d')) AS _row_id
        FROM orders_in""",
    "symbols_filter": f"""WITH {_RATES}
        SELECT strftime(date, '%Y-%m-%d') AS date, base, currency, CAST(rate AS DOUBLE) AS rate
        FROM rates WHERE currency IN ('S1', 'S2', 'S3', 'S5', 'S8')""",
    "local_time": f"SELECT event_id, {_local('ts')} AS local_ts FROM events",
    "load_replace_twice": f"WITH {_ORDERS} SELECT {_ORDER_ROW}, o_totalprice FROM orders_in",
    "load_append_batches": f"WITH {_ORDERS} SELECT {_ORDER_ROW}, o_totalprice FROM orders_in",
    "merge_upsert": f"""
        WITH corrected AS (
          SELECT {_LINE_COLUMNS.replace("l_quantity", "l_quantity + 100 AS l_quantity")}
          FROM lineitem WHERE l_returnflag = 'R'
          UNION ALL
          SELECT {_LINE_COLUMNS.replace("l_linenumber", "l_linenumber + 10 AS l_linenumber")}
          FROM lineitem WHERE l_returnflag = 'R'),
        old AS (SELECT {_LINE_COLUMNS} FROM {_latest("lineitem")}),
        new AS (SELECT {_LINE_COLUMNS} FROM {_latest("corrected")}),
        merged AS (
          SELECT * FROM new
          UNION ALL
          SELECT * FROM old WHERE NOT EXISTS (
            SELECT 1 FROM new
            WHERE new.l_orderkey = old.l_orderkey AND new.l_linenumber = old.l_linenumber))
        SELECT {_LINE_ROW} FROM merged""",
    "merge_idempotent": """
        SELECT n AS rows_once, n AS rows_twice, CAST(0 AS BIGINT) AS rows_changed
        FROM (SELECT COUNT(*) AS n FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))""",
    "latest_line_per_key": f"SELECT {_LINE_ROW} FROM {_latest('lineitem')}",
    "schema_evolution": """
        SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS c_mktsegment
        FROM customer""",
    "incremental_no_lag": _two_loads("day >= hwm"),
    "incremental_lag_days": _two_loads("day >= hwm - 30"),
    "reconcile_long_lag": _two_loads("day >= hwm - 365"),
    "bounded_backfill": _two_loads("day BETWEEN DATE '1996-01-01' AND DATE '1996-06-30'"),
    "full_refresh": _two_loads("TRUE", keep_first=False),
    "auto_history": f"""WITH {_ORDERS}
        SELECT {_ORDER_ROW}, o_totalprice FROM orders_in WHERE day >= DATE '1996-01-01'""",
    "summary_of_loads": f"""WITH {_ORDERS}
        SELECT 'orders' AS "table", CAST(1 AS BIGINT) AS seq, 'merge' AS action, COUNT(*) AS n_rows
        FROM orders_in WHERE day <= DATE '1997-12-31'
        UNION ALL SELECT 'orders', 2, 'merge', COUNT(*) FROM orders_in
        UNION ALL SELECT 'customer', 1, 'replace', COUNT(*) FROM customer""",
    "lower_correction": f"""WITH {_DAILY_RATES}
        SELECT how, strftime(date, '%Y-%m-%d') AS date, 'EUR' AS base, currency,
               CAST(rate AS DOUBLE) / CASE WHEN day(date) % 3 = 0 THEN 2 ELSE 1 END AS rate
        FROM daily_rates, (VALUES ('together'), ('one by one'), ('stream')) AS t(how)""",
    "catalog_picture_in_parts": """
        SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS code, s_name || ' 1' AS name
        FROM supplier WHERE s_acctbal > 0""",
    "rejected_rows": f"""WITH {_ORDERS},
        messy AS (
          SELECT CASE WHEN o_orderstatus <> 'P' THEN day END AS day,
                 CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey, o_custkey,
                 o_orderstatus, CASE WHEN o_custkey % 5 <> 0 THEN o_totalprice END AS o_totalprice
          FROM orders_in)
        SELECT {_ORDER_ROW}, o_totalprice,
               CASE WHEN day IS NULL THEN 'null o_orderdate'
                    WHEN o_orderkey IS NULL THEN 'null o_orderkey'
                    WHEN o_totalprice IS NULL THEN 'null o_totalprice'
                    WHEN day < DATE '1996-01-01' THEN 'before the window'
                    WHEN day > DATE '1997-06-30' THEN 'after the window' END AS reject_reason
        FROM messy""",
    "stream_late_rows": f"""WITH {_DAILY_RATES},
        mark AS (SELECT MAX(date) - 30 AS start FROM daily_rates WHERE date <= DATE '1997-12-31'),
        corrected AS (SELECT date, currency, rate + 1 AS rate FROM daily_rates WHERE day(date) % 2 = 0),
        stored AS (
          SELECT d.date, d.currency, CASE WHEN c.date >= start THEN c.rate ELSE d.rate END AS rate
          FROM daily_rates d CROSS JOIN mark
          LEFT JOIN corrected c ON d.date = c.date AND d.currency = c.currency
          WHERE d.date <= DATE '1997-12-31' OR c.date >= start)
        SELECT strftime(date, '%Y-%m-%d') AS date, 'EUR' AS base, currency,
               CAST(rate AS DOUBLE) AS rate, NULL AS reject_reason FROM stored
        UNION ALL
        SELECT strftime(date, '%Y-%m-%d'), 'EUR', currency, CAST(rate AS DOUBLE), 'before the window'
        FROM corrected, mark WHERE date < start""",
    "schema_evolution_decimals": f"""
        SELECT c_custkey, {", ".join(_share(part, kind) for part, kind in enumerate(_KINDS))}
        FROM customer""",
    "merge_after_replace": f"""WITH {_ORDERS}
        SELECT {_ORDER_ROW}, o_totalprice + 1000 AS o_totalprice FROM orders_in""",
    "merge_after_bucket_change": f"""
        SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate,
               l_suppkey, l_quantity, l_returnflag FROM (
          SELECT * FROM {_latest("lineitem")} WHERE (l_orderkey, l_linenumber) NOT IN (
            SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag = 'R')
          UNION ALL
          SELECT * REPLACE (l_quantity + 100 AS l_quantity)
          FROM {_latest("(SELECT * FROM lineitem WHERE l_returnflag = 'R')")})""",
    "scd2_repeated_keys": f"""
        WITH pictures AS (
          SELECT 1 AS n, c_custkey, c_mktsegment AS m FROM customer
          UNION ALL SELECT 2, c_custkey, {_RENAMED} FROM customer WHERE c_acctbal >= 0
          UNION ALL SELECT 3, c_custkey, c_mktsegment FROM customer),
        chosen AS (
          SELECT n, c_custkey, CASE WHEN c_custkey % 3 = 0 AND m < 'A segment'
                                    THEN 'A segment' ELSE m END AS m FROM pictures),
        p1 AS (SELECT * FROM chosen WHERE n = 1), p2 AS (SELECT * FROM chosen WHERE n = 2),
        p3 AS (SELECT * FROM chosen WHERE n = 3)
        SELECT p1.c_custkey, p1.m AS c_mktsegment, {_T1} AS dbt_valid_from,
               CASE WHEN p2.m IS NULL OR p2.m <> p1.m THEN {_T2} WHEN p3.m <> p2.m THEN {_T3} END
                 AS dbt_valid_to
        FROM p1 LEFT JOIN p2 USING (c_custkey) JOIN p3 USING (c_custkey)
        UNION ALL
        SELECT p2.c_custkey, p2.m, {_T2}, CASE WHEN p3.m <> p2.m THEN {_T3} END
        FROM p2 JOIN p1 USING (c_custkey) JOIN p3 USING (c_custkey) WHERE p2.m <> p1.m
        UNION ALL
        SELECT p3.c_custkey, p3.m, {_T3}, NULL
        FROM p3 LEFT JOIN p2 USING (c_custkey) WHERE p2.m IS NULL OR p2.m <> p3.m""",
    "stream_merged_payloads": f"""WITH {_RATES}
        SELECT strftime(date, '%Y-%m-%d') AS date, 'EUR' AS base, currency,
               CAST(MAX(rate) AS DOUBLE) AS rate, CAST(1 AS DOUBLE) AS amount
        FROM rates GROUP BY 1, 3""",
    "windows_per_customer": f"""WITH {_ORDERS},
        ranges AS (
          SELECT o_custkey, MIN(day) AS lo, MAX(day) AS hi FROM orders_in GROUP BY 1),
        starts AS (
          SELECT *, CAST(UNNEST(generate_series(lo, hi, INTERVAL 90 DAY)) AS DATE) AS s FROM ranges)
        SELECT o_custkey, strftime(lo, '%Y-%m-%d') AS range_start,
               strftime(hi, '%Y-%m-%d') AS range_end, strftime(s, '%Y-%m-%d') AS window_start,
               strftime(LEAST(s + 89, hi), '%Y-%m-%d') AS window_end
        FROM starts""",
    "gaps_per_entity": f"""WITH {_LINE_QUOTES},
        weekdays AS (
          SELECT d, ROW_NUMBER() OVER (ORDER BY d) AS n
          FROM (SELECT CAST(UNNEST(generate_series(MIN(date), MAX(date), INTERVAL 1 DAY)) AS DATE)
                       AS d FROM line_quotes)
          WHERE EXTRACT(isodow FROM d) < 6),
        entities AS (
          SELECT 'S' || CAST(s_suppkey AS VARCHAR) AS currency FROM supplier
          UNION SELECT currency FROM line_quotes
          UNION SELECT 'X' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0),
        missing AS (
          SELECT currency, d, n, n - ROW_NUMBER() OVER (PARTITION BY currency ORDER BY n) AS island
          FROM entities CROSS JOIN weekdays
          WHERE (currency, d) NOT IN (SELECT (currency, date) FROM line_quotes))
        SELECT currency, strftime(MIN(d), '%Y-%m-%d') AS gap_start,
               strftime(MAX(d), '%Y-%m-%d') AS gap_end, CAST(COUNT(*) AS INTEGER) AS n_days
        FROM missing GROUP BY currency, island""",
    "scd2_check": _history(returned=False, hard_deletes=False),
    "scd2_hard_delete": _history(returned=False),
    "scd2_return": _history(returned=True),
    "history_dim": f"""WITH h AS ({_history(returned=False)})
        SELECT MD5(CAST(c_custkey AS VARCHAR) || '-' || dbt_valid_from || '.000000') AS clave_version,
               MD5(CAST(c_custkey AS VARCHAR)) AS clave_moneda,
               CAST(c_custkey AS VARCHAR) AS codigo_moneda, c_mktsegment AS nombre_moneda,
               {_local("dbt_valid_from")} AS valido_desde, {_local("dbt_valid_to")} AS valido_hasta,
               dbt_valid_to IS NULL AS es_version_vigente
        FROM h""",
    "asof_segment": f"""WITH h AS ({_history(returned=True)})
        SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
               c_mktsegment
        FROM orders LEFT JOIN h ON o_custkey = c_custkey
         AND CAST(dbt_valid_from AS TIMESTAMP) <= o_orderdate
         AND (dbt_valid_to IS NULL OR o_orderdate < CAST(dbt_valid_to AS TIMESTAMP))""",
    "versions_in_force": f"""
        SELECT c_custkey, {_RENAMED} AS c_mktsegment FROM customer WHERE c_acctbal >= 0""",
    "check_not_null": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'",
    "check_unique": """
        SELECT l_orderkey, COUNT(*) AS n_records FROM lineitem GROUP BY 1 HAVING COUNT(*) > 1""",
    "check_unique_combination": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n_records
        FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "check_between": """
        SELECT l_orderkey, l_linenumber, l_quantity
        FROM lineitem WHERE NOT (l_quantity > 5 AND l_quantity < 45)""",
    "check_length": "SELECT c_custkey, c_mktsegment FROM customer WHERE LENGTH(c_mktsegment) <> 9",
    "check_relationships": """
        SELECT l_suppkey, COUNT(*) AS n_records FROM lineitem
        WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 2000) GROUP BY 1""",
    "check_reciprocal": f"""WITH {_RATES},
        inverses AS (
          SELECT *, CAST(ROUND(1.0 / CAST(rate AS DOUBLE), 8) AS DECIMAL(10,8)) AS inverse FROM rates)
        SELECT strftime(date, '%Y-%m-%d') AS date, base, currency, CAST(rate AS DOUBLE) AS rate,
               CAST(inverse AS DOUBLE) AS inverse
        FROM inverses WHERE ABS(rate * inverse - 1) > 0.00000001""",
    "check_future": f"""WITH {_LINE_QUOTES}
        SELECT strftime(date, '%Y-%m-%d') AS date, COUNT(*) AS n_records
        FROM line_quotes WHERE date > DATE '1999-06-01' GROUP BY 1""",
    "freshness_status": " UNION ALL ".join(
        _freshness(t, "pass")
        for t in ("2024-01-31 00:00:00", "2024-02-01 18:00:00", "2024-03-01 00:00:00")
    ),
    "severity_gate": " UNION ALL ".join(_check(*rule) for rule in _RULES),
    "check_session_timezone": """
        WITH days AS (
          SELECT CAST(timezone('Asia/Tokyo', timezone('UTC', ts)) AS DATE) AS s,
                 CAST(timezone('America/Argentina/Buenos_Aires', timezone('UTC', ts)) AS DATE) AS e
          FROM events)
        SELECT 'Asia/Tokyo' AS session_zone, 'America/Argentina/Buenos_Aires' AS expected_zone,
               strftime(s, '%Y-%m-%d') AS session_day, strftime(e, '%Y-%m-%d') AS expected_day,
               COUNT(*) AS n_records
        FROM days WHERE s <> e GROUP BY s, e""",
    "audit_rows": """
        WITH runs AS (
          SELECT 'odd' AS run, * FROM lineitem WHERE l_orderkey % 2 = 1
          UNION ALL SELECT 'all', * FROM lineitem),
        found AS (
          SELECT run, 'between_l_discount' AS "check", l_orderkey, l_linenumber, l_discount,
                 CAST(NULL AS BIGINT) AS n_records
          FROM runs WHERE l_discount < 0 OR l_discount > 0.05
          UNION ALL
          SELECT run, 'between_l_discount#2', l_orderkey, l_linenumber, l_discount, NULL
          FROM runs WHERE l_discount < 0.02 OR l_discount > 0.1
          UNION ALL
          SELECT run, 'unique_combination_l_orderkey_l_linenumber', l_orderkey, l_linenumber, NULL,
                 COUNT(*)
          FROM runs GROUP BY run, l_orderkey, l_linenumber HAVING COUNT(*) > 1)
        SELECT *, TRUE AS id_is_of_key FROM found""",
    "raw_profile": " UNION ALL ".join(
        [
            _profile("lineitem", "lineitem", "l_orderkey, l_linenumber", "l_shipdate"),
            _profile(
                "orders",
                """(SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS day
                    FROM orders) o""",
                "o_orderkey",
                "day",
            ),
            _profile("customer", "customer", "c_custkey", None),
            "SELECT 'nowhere', TRUE, NULL, NULL, NULL, NULL, NULL, 1",
        ]
    ),
}
