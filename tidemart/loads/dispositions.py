"""Replace, append, merge and snapshot loads."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (
    AtomicType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
)

from tidemart.loads.warehouse import PART, TableState, Warehouse, month_layout, new_load_id
from tidemart.operators.dedup import latest_by_key
from tidemart.operators.scd2 import VALID_FROM, VALID_TO, step_snapshot
from tidemart.specs import ARRIVAL, AUDIT, MATERIALIZATION, TableSpec

SIDE, OPEN, CLOSED = "load_side", "open", "closed"

_INTEGERS = (ByteType(), ShortType(), IntegerType(), LongType())
_DIGITS = {ByteType(): 3, ShortType(): 5, IntegerType(): 10, LongType(): 19}


def _wider(a: DataType, b: DataType) -> DataType | None:
    """The type that holds every value of both and that old files can be read as."""
    if a == b:
        return a
    if a in _INTEGERS and b in _INTEGERS:
        return max(a, b, key=_INTEGERS.index)
    pair = {a, b}
    if pair == {FloatType(), DoubleType()}:
        return DoubleType()
    if DoubleType() in pair and pair <= {DoubleType(), *_INTEGERS[:3]}:
        return DoubleType()
    if all(isinstance(t, DecimalType) or t in _INTEGERS for t in pair):
        whole = max(t.precision - t.scale if isinstance(t, DecimalType) else _DIGITS[t] for t in pair)
        scale = max(t.scale if isinstance(t, DecimalType) else 0 for t in pair)
        if whole + scale <= 38:
            return DecimalType(whole + scale, scale)
    return None


def _side_name(name: str, data_type: DataType) -> str:
    """Name of the side column of values of a type: the whole type, so that none is cast.

    ``rate__v_decimal_10_8``; a type with fields, whose names may hold any character,
    is named by its digest.
    """
    full = data_type.simpleString()
    kind = re.sub(r"[^a-z0-9]+", "_", full).strip("_")
    if not isinstance(data_type, AtomicType):
        kind = f"{data_type.typeName()}_{hashlib.sha256(full.encode()).hexdigest()[:12]}"
    return f"{name}__v_{kind}"


def evolve(schema: StructType, batch: DataFrame) -> tuple[StructType, DataFrame]:
    """Table schema after the batch, and the batch cast to it.

    New columns join the table and numbers widen. A column that comes with an
    incompatible type goes to a side column named after that very type, precision and
    scale included; no value is dropped, rounded or turned into null.
    """
    fields = {f.name: f for f in schema.fields}
    casts: list[Column] = []
    for incoming in batch.schema.fields:
        name = incoming.name
        known = fields.get(name)
        if known is None:
            fields[name] = StructField(name, incoming.dataType, True)
        else:
            target = _wider(known.dataType, incoming.dataType)
            if target is None:
                name = _side_name(name, incoming.dataType)
                fields.setdefault(name, StructField(name, incoming.dataType, True))
            elif target != known.dataType:
                fields[name] = StructField(name, target, known.nullable)
        casts.append(F.col(f"`{incoming.name}`").cast(fields[name].dataType).alias(name))
    return StructType(list(fields.values())), batch.select(*casts)


def _conform(df: DataFrame, schema: StructType) -> DataFrame:
    """All columns of the schema in its order, absent ones as null."""
    have = set(df.columns)
    return df.select(
        *(
            F.col(f"`{f.name}`") if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
            for f in schema.fields
        )
    )


# -- whole-table loads ---------------------------------------------------------


def write_replace(
    wh: Warehouse,
    df: DataFrame,
    layer: str,
    table: str,
    n_dropped: int = 0,
    load_id: str | None = None,
) -> DataFrame:
    """Writes a table anew and returns it for reading."""
    previous = wh.state(layer, table)
    df, load_id = df.drop(ARRIVAL), load_id or new_load_id()
    folder = wh.folder(layer, table, load_id)
    df.write.parquet(folder)
    written = wh.read_folders(df.schema, [folder])
    wh.commit(
        layer,
        table,
        "replace",
        df.schema,
        {"all": folder},
        load_id,
        written.count(),
        n_dropped=n_dropped,
        previous=previous,
    )
    return written


def load_replace(
    wh: Warehouse, df: DataFrame, spec: TableSpec, n_dropped: int = 0, load_id: str | None = None
) -> None:
    """The table becomes exactly this batch."""
    write_replace(wh, df, spec.layer, spec.name, n_dropped, load_id)


def load_append(
    wh: Warehouse, df: DataFrame, spec: TableSpec, n_dropped: int = 0, load_id: str | None = None
) -> None:
    """Adds the batch; only for sources that never send a row twice."""
    previous = wh.state(spec.layer, spec.name)
    df, load_id = df.drop(ARRIVAL), load_id or new_load_id()
    schema, batch = evolve(previous.schema if previous else df.schema, df)
    folder = wh.folder(spec.layer, spec.name, load_id)
    _conform(batch, schema).write.parquet(folder)
    wh.commit(
        spec.layer,
        spec.name,
        "append",
        schema,
        {**(previous.folders if previous else {}), load_id: folder},
        load_id,
        wh.read_folders(schema, [folder]).count(),
        cursor=previous.cursor if previous else None,
        n_dropped=n_dropped,
        previous=previous,
    )


def month_of(column: str) -> Column:
    """Partition number of a date: 202601."""
    return (F.year(column) * 100 + F.month(column)).cast("int")


def replace_months(
    wh: Warehouse,
    df: DataFrame,
    layer: str,
    table: str,
    by: str,
    months: Iterable[int] | None = None,
    batch: str | None = None,
    month: Column | None = None,
    dealt: bool = False,
) -> DataFrame:
    """Writes the given months of a table anew, all if none are given; others stay.

    ``df`` has the rows of those months and no others; a month without rows goes. The
    month is that of the date ``by``, or ``month``, a number such as 202601. Returns the
    rows written. A table whose months are kept must have the same columns as before.
    ``dealt`` rows are in few tasks for each month already and are written from there.
    """
    previous = wh.state(layer, table)
    load_id = new_load_id()
    folder = f"{wh.folder(layer, table, load_id)}/{month_layout(by)}"
    parts = df.withColumn(PART, month_of(by) if month is None else month)
    if dealt:
        parts.write.partitionBy(PART).parquet(folder)
    else:
        _write_parts(parts, folder)
    stored = wh.spark.read.schema(_with_part(df.schema)).parquet(folder)
    counts = {str(r[0]): r[1] for r in stored.groupBy(PART).count().collect()}  # one row a month
    folders = {}
    if months is not None:
        if previous is not None and previous.schema != df.schema:
            raise ValueError(f"{layer}.{table}: other columns than those of the months kept")
        gone = {str(m) for m in months}
        if not set(counts) <= gone:
            raise ValueError(f"{layer}.{table}: rows outside the months to replace")
        folders = {p: f for p, f in (previous.folders if previous else {}).items() if p not in gone}
    written = {p: f"{folder}/{PART}={p}" for p in counts}
    wh.commit(
        layer,
        table,
        "replace" if months is None else "months",
        df.schema,
        folders | written,
        load_id,
        sum(counts.values()),
        previous=previous,
        batch=batch,
    )
    return wh.read_folders(df.schema, sorted(written.values()))


# -- merge by key --------------------------------------------------------------


def _part(spec: TableSpec) -> Column:
    if spec.by_month:
        return F.coalesce(month_of(spec.cursor), F.lit(0))
    return F.pmod(F.xxhash64(*spec.keys), F.lit(spec.buckets)).cast("int")


def _layout(spec: TableSpec) -> str:
    """How a merge deals rows out; the folder name in which its partitions lie."""
    if spec.by_month:
        return month_layout(spec.cursor)
    return f"hash-{spec.buckets}-{'-'.join(spec.keys)}"


def _write_parts(df: DataFrame, folder: str) -> None:
    # Rebalancing cuts large partitions over several tasks and joins small ones.
    df.hint("rebalance", PART).write.partitionBy(PART).parquet(folder)


@dataclass(frozen=True)
class _Loaded:
    """What a written batch holds, from one scan of its partition and cursor columns."""

    parts: list[str]
    n_rows: int
    newest: str | None


def _loaded(df: DataFrame, spec: TableSpec) -> _Loaded:
    """One row per partition reaches the driver: months, or a fixed number of buckets."""
    newest = F.max(spec.cursor).cast("string") if spec.cursor else F.lit(None).cast("string")
    found = df.groupBy(PART).agg(F.count(F.lit(1)), newest).collect()
    cursors = [r[2] for r in found if r[2] is not None]
    return _Loaded([str(r[0]) for r in found], sum(r[1] for r in found), max(cursors, default=None))


def load_merge(
    wh: Warehouse,
    df: DataFrame,
    spec: TableSpec,
    refresh: bool = False,
    move_cursor: bool = True,
    n_dropped: int = 0,
    n_read: int | None = None,
    batch_name: str | None = None,
    load_id: str | None = None,
) -> None:
    """Upsert by key.

    Rows with a known key replace the old row, other rows are added, repeated
    keys in the batch collapse to the last one, and rows not mentioned stay. The last
    one is that which arrived last, where the batch has a column ``ARRIVAL``, then the
    last by the spec's order.
    Only partitions the batch touches are read and rewritten; a table laid out in
    another way (by a replace, an append, or other ``buckets``) is dealt anew once.
    ``refresh`` starts
    from an empty table and cursor; the old rows serve readers until the load is
    complete. ``move_cursor=False`` keeps the incremental cursor where it was.
    """
    previous = wh.state(spec.layer, spec.name)
    base = None if refresh else previous
    schema, batch = evolve(base.schema if base else df.schema, df)
    absent = [k for k in spec.keys if k not in batch.columns]
    if absent:
        raise ValueError(f"{spec.name}: batch lacks key columns of the table's type: {absent}")
    order = [*([ARRIVAL] if ARRIVAL in batch.columns else []), *spec.order_by]
    batch = latest_by_key(_conform(batch, schema), spec.keys, order).drop(ARRIVAL)
    batch = batch.withColumn(PART, _part(spec))
    schema = StructType([f for f in schema.fields if f.name != ARRIVAL])

    load_id = load_id or new_load_id()
    folder = f"{wh.folder(spec.layer, spec.name, load_id)}/{_layout(spec)}"
    stored = wh.spark.read.schema(_with_part(schema))
    if base is None:
        _write_parts(batch, folder)
        loaded = _loaded(stored.parquet(folder), spec)
        folders, touched = {}, loaded.parts
    else:
        # The batch is written out once: what follows reads it several times and
        # must see the same rows even if an executor is lost in between.
        incoming = f"{wh.root}/incoming/{spec.layer}/{spec.name}/{load_id}"
        batch.write.parquet(incoming)
        new = stored.parquet(incoming)
        loaded = _loaded(new, spec)
        # Keys may lie elsewhere if one widened or the table has another layout: then
        # all partitions are rewritten.
        rekeyed = any(base.schema[k].dataType != schema[k].dataType for k in spec.keys) or any(
            not path.endswith(f"/{_layout(spec)}/{PART}={part}")
            for part, path in base.folders.items()
        )
        folders = {} if rekeyed else dict(base.folders)
        affected = sorted(base.folders) if rekeyed else loaded.parts
        old = wh.read_folders(schema, [base.folders[p] for p in affected if p in base.folders])
        same_key = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in spec.keys]
        kept = old.alias("old").join(new.select(*spec.keys).alias("new"), same_key, "left_anti")
        _write_parts(kept.withColumn(PART, _part(spec)).unionByName(new), folder)
        touched = _loaded(stored.parquet(folder), spec).parts if rekeyed else affected
    folders.update({p: f"{folder}/{PART}={p}" for p in touched})

    wh.commit(
        spec.layer,
        spec.name,
        "refresh" if refresh else "merge",
        schema,
        folders,
        load_id,
        loaded.n_rows,
        cursor=_cursor(base, loaded.newest) if move_cursor else (base.cursor if base else None),
        n_dropped=n_dropped,
        previous=previous,
        n_read=n_read,
        batch=batch_name,
    )


def _with_part(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(PART, IntegerType())])


def _cursor(base: TableState | None, newest: str | None) -> str | None:
    """The later of two cursors; ISO texts of one width compare like their values."""
    seen = [c for c in (base.cursor if base else None, newest) if c is not None]
    return max(seen, default=None)


# -- history snapshot ----------------------------------------------------------


@contextmanager
def open_versions(
    wh: Warehouse, spec: TableSpec, schema: StructType, folder: str | None
) -> Iterator[DataFrame]:
    """Open versions of a history, in their buckets.

    Only a catalog table tells Spark of buckets: one is declared over the folder for as
    long as it is read.
    """
    if folder is None or f"/{_bucketed(spec)}/" not in folder:
        yield wh.read_folders(schema, [folder] if folder else [])
        return
    name = f"open_versions_{new_load_id()}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in spec.keys)
    path = folder.replace("'", "\\'")
    wh.spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
        f"INTO {spec.buckets} BUCKETS LOCATION '{path}'"
    )
    try:
        yield wh.spark.table(name)
    finally:
        wh.spark.sql(f"DROP TABLE {name}")  # the folder stays


def _bucketed(spec: TableSpec) -> str:
    return f"buckets-{spec.buckets}-{'-'.join(spec.keys)}"


def load_snapshot(
    wh: Warehouse,
    batch: DataFrame,
    spec: TableSpec,
    check_cols: list[str],
    at: datetime,
    hard_deletes: bool = True,
) -> None:
    """Folds a catalog picture into its Type 2 history table.

    Open and closed versions lie in separate folders. A load reads and rewrites
    the open ones and adds a folder with those it closed, so its cost follows
    the size of the catalog, not the length of the history. Open versions lie in
    buckets by key: a load shuffles the picture, but not them. Rows without a key are
    left out and counted as dropped.
    """
    previous = wh.state(spec.layer, spec.name)
    fields = batch.select(*spec.keys, *check_cols).schema.fields
    times = StructType.fromDDL(f"{VALID_FROM} TIMESTAMP, {VALID_TO} TIMESTAMP").fields
    schema = StructType([*fields, *times])
    folders = dict(previous.folders) if previous else {}
    was_open = folders.pop(OPEN, None)

    has_key = reduce(and_, (F.col(f"`{k}`").isNotNull() for k in spec.keys))
    load_id = new_load_id()
    counts = Observation(f"snapshot-{load_id}")
    seen = batch.observe(counts, F.count_if(~has_key).alias("n_dropped")).filter(has_key)
    folder = f"{wh.folder(spec.layer, spec.name, load_id)}/{_bucketed(spec)}"
    side = F.when(F.col(VALID_TO).isNull(), OPEN).otherwise(CLOSED)
    written = f"versions_{load_id}"
    with open_versions(wh, spec, schema, was_open) as old:
        versions = step_snapshot(old, seen, spec.keys, check_cols, at, hard_deletes, spec.buckets)
        bucketed = versions.withColumn(SIDE, side).write.partitionBy(SIDE)
        bucketed.bucketBy(spec.buckets, *spec.keys).option("path", folder).saveAsTable(written)
    wh.spark.sql(f"DROP TABLE {written}")  # the folder stays
    sided = StructType([*schema.fields, StructField(SIDE, StringType())])
    n_rows = {
        r[0]: r[1]
        for r in wh.spark.read.schema(sided).parquet(folder).groupBy(SIDE).count().collect()
    }
    if OPEN in n_rows:
        folders[OPEN] = f"{folder}/{SIDE}={OPEN}"
    if CLOSED in n_rows:
        folders[f"{CLOSED}-{load_id}"] = f"{folder}/{SIDE}={CLOSED}"
    wh.commit(
        spec.layer,
        spec.name,
        "snapshot",
        schema,
        folders,
        load_id,
        sum(n_rows.values()),
        n_dropped=counts.get["n_dropped"],
        previous=previous,
    )


# -- summary -------------------------------------------------------------------


def load_summary(wh: Warehouse, specs: list[TableSpec]) -> DataFrame:
    """Rows and load ids per declared table; internal tables are not declared."""
    summary = None
    for spec in specs:
        one = wh.log(spec.layer, spec.name).select(
            "layer", "table", "seq", "load_id", "action", "n_rows", "n_dropped", "n_read", "loaded_at"
        )
        summary = one if summary is None else summary.unionByName(one)
    if summary is None:
        raise ValueError("no tables to summarise")
    return summary


def materialize(wh: Warehouse, df: DataFrame, layer: str, name: str) -> DataFrame:
    """Realises a model the way its layer asks for and returns it for reading."""
    kind = MATERIALIZATION[layer]
    if kind == "table":
        return write_replace(wh, df, layer, name)
    if kind == "view":
        df.createOrReplaceTempView(name)
    return df


# -- audit -----------------------------------------------------------------------

_VIOLATIONS = "violations"
_AUDIT = "row_id STRING, `row` STRING, found_at TIMESTAMP, `table` STRING, `check` STRING, run STRING"


def _audit_path(wh: Warehouse) -> str:
    return f"{wh.root}/{AUDIT}/{_VIOLATIONS}"


def store_failures(
    wh: Warehouse, table: str, run: str | None = None, keys: Sequence[str] = ()
) -> Callable[[str, DataFrame], None]:
    """A sink for `enforce`: failing rows of every check, added to the audit table.

    The table is partitioned by table, check and ``run``, one call of this function if
    none is named, so that each run's findings stay. ``row`` is the row as JSON, and
    ``row_id`` a digest of its ``keys``, or of the whole row where it lacks them: the
    same row has the same id in every run. A run that died may have left part of its rows.
    """
    run = run or new_load_id()

    def place(check: str) -> str:
        # A folder of its own for each writer: those of one folder disturb each other.
        parts = {"table": table, "check": check, "run": run}
        return "/".join(f"{name}={quote(value, safe='')}" for name, value in parts.items())

    def store(check: str, violations: DataFrame) -> None:
        every = [F.col(f"`{c}`") for c in violations.columns]
        known = bool(keys) and set(keys) <= set(violations.columns)
        named = [F.col(f"`{k}`") for k in keys] if known else every
        nulls = {"ignoreNullFields": "false"}
        violations.select(
            F.sha2(F.to_json(F.struct(*named), nulls), 256).alias("row_id"),
            F.to_json(F.struct(*every), nulls).alias("row"),
            F.current_timestamp().alias("found_at"),
        ).write.mode("append").parquet(f"{_audit_path(wh)}/{place(check)}")

    return store


def audit_rows(wh: Warehouse) -> DataFrame:
    """All failing rows kept so far; filters on table, check and run open only their folders."""
    try:
        return wh.spark.read.schema(_AUDIT).parquet(_audit_path(wh))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return wh.spark.createDataFrame([], _AUDIT)
