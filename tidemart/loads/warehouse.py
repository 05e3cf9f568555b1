"""Where tables live: Parquet folders, and a log of completed loads.

Spark can neither update Parquet in place nor safely overwrite a path it reads
from. A load therefore writes new folders and, once they are complete, appends
one row to the table's load log saying which folders the table now consists of,
along with its schema and cursor. Readers follow the last row: they see a load
whole or not at all, and a job that dies half-way leaves the table as it was.
One writer per table at a time, as with the reference's build lock.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from datetime import UTC, date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOG = (
    "seq BIGINT, load_id STRING, layer STRING, `table` STRING, action STRING, "
    "folders MAP<STRING, STRING>, schema STRING, cursor STRING, "
    "n_rows BIGINT, n_dropped BIGINT, n_read BIGINT, batch STRING, loaded_at TIMESTAMP"
)

# The column whose values name a table's partitions, each a folder of its own.
PART = "load_part"


def month_layout(cursor: str) -> str:
    """Folder name of partitions that are the months of ``cursor``."""
    return f"month-{cursor}"


def new_load_id() -> str:
    return uuid.uuid4().hex


@dataclass(frozen=True)
class TableState:
    """A table after its last load. ``folders`` maps a partition to its folder."""

    seq: int
    schema: StructType
    folders: dict[str, str] = field(default_factory=dict)
    cursor: str | None = None
    batch: str | None = None


class Warehouse:
    """Tables under ``root``, one folder per layer."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def folder(self, layer: str, table: str, load_id: str) -> str:
        return f"{self.root}/{layer}/{table}/{load_id}"

    def _log_path(self, layer: str, table: str) -> str:
        return f"{self.root}/load_log/{layer}/{table}"

    def log(self, layer: str, table: str) -> DataFrame:
        """Completed loads of one table, empty if there were none."""
        try:
            return self.spark.read.schema(_LOG).json(self._log_path(layer, table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], _LOG)

    def state(self, layer: str, table: str, seq: int | None = None) -> TableState | None:
        """The table after its last load, or after load ``seq``."""
        loads = self.log(layer, table)
        loads = loads if seq is None else loads.filter(F.col("seq") == seq)
        last = loads.orderBy(F.desc("seq")).first()
        if last is None:
            return None
        return TableState(
            seq=last["seq"],
            schema=StructType.fromJson(json.loads(last["schema"])),
            folders=last["folders"] or {},
            cursor=last["cursor"],
            batch=last["batch"],
        )

    def commit(
        self,
        layer: str,
        table: str,
        action: str,
        schema: StructType,
        folders: dict[str, str],
        load_id: str,
        n_rows: int,
        cursor: str | None = None,
        n_dropped: int = 0,
        previous: TableState | None = None,
        n_read: int | None = None,
        batch: str | None = None,
    ) -> None:
        """Makes a load visible: one row, written by one task, appears as one file.

        ``n_read`` rows came in, ``n_dropped`` of them were turned away and ``n_rows``
        went in; the others repeated a key. ``batch`` names what was loaded, so that a
        replay can be told.
        """
        entry = {
            "seq": previous.seq + 1 if previous else 1,
            "load_id": load_id,
            "layer": layer,
            "table": table,
            "action": action,
            "folders": folders,
            "schema": schema.json(),
            "cursor": cursor,
            "n_rows": n_rows,
            "n_dropped": n_dropped,
            "n_read": n_rows + n_dropped if n_read is None else n_read,
            "batch": batch,
            "loaded_at": datetime.now(UTC).isoformat(),
        }
        line = self.spark.range(0, 1, 1, 1).select(F.lit(json.dumps(entry)).alias("value"))
        line.write.mode("append").text(self._log_path(layer, table))

    def read_folders(self, schema: StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*folders)

    def read_state(self, state: TableState) -> DataFrame:
        return self.read_folders(state.schema, sorted(set(state.folders.values())))

    def read(self, layer: str, table: str) -> DataFrame:
        """A table by layer and name; columns added later are null in older files."""
        state = self.state(layer, table)
        if state is None:
            raise LookupError(f"no table {layer}.{table}")
        return self.read_state(state)

    def read_between(
        self, layer: str, table: str, cursor: str, start: date, end: date | None = None
    ) -> DataFrame:
        """Rows whose ``cursor`` lies in [start, end].

        Of a table dealt out by the months of ``cursor`` only the folders of those months
        are listed and opened.
        """
        state = self.state(layer, table)
        if state is None:
            raise LookupError(f"no table {layer}.{table}")
        low, high = start.year * 100 + start.month, end.year * 100 + end.month if end else 999912
        monthly = f"/{month_layout(cursor)}/{PART}="
        folders = {
            path
            for part, path in state.folders.items()
            if monthly not in path or low <= int(part) <= high
        }
        inside = F.col(cursor) >= F.lit(start)
        if end is not None:
            inside = inside & (F.col(cursor) < F.lit(end + timedelta(days=1)))
        return self.read_folders(state.schema, sorted(folders)).filter(inside)

    def exists(self, layer: str, table: str) -> bool:
        return self.state(layer, table) is not None

    def is_empty(self, layer: str, table: str) -> bool:
        """True if the table does not exist or has no rows (looks for one row only)."""
        state = self.state(layer, table)
        return state is None or self.read_state(state).isEmpty()

    def unused_folders(self, layer: str, table: str) -> DataFrame:
        """Folders of earlier loads that the table no longer consists of."""
        state = self.state(layer, table)
        current = sorted(set(state.folders.values())) if state else []
        ever = self.log(layer, table).select(F.explode("folders").alias("part", "folder"))
        return ever.select("folder").distinct().filter(~F.col("folder").isin(current))
