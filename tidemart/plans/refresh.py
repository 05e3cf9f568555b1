"""Which months of the marts a load has made out of date.

Raw quotes, fact and report lie in one folder a month. A mart's log says of which load
of the raw table it was made; months whose folder has changed since are to be made
anew, and so is the month of each pair's next quote, which refers to the one before.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemart.loads import TableState, Warehouse, month_of
from tidemart.loads.warehouse import PART, month_layout
from tidemart.plans.marts import PAIR
from tidemart.specs import TableSpec


@dataclass(frozen=True)
class MadeOf:
    """What a mart was made of: loads of its inputs, and the days its calendar covers."""

    raw: int
    closes: int
    first_day: str
    end: str

    def __str__(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def of(state: TableState | None) -> MadeOf | None:
        return MadeOf(**json.loads(state.batch)) if state and state.batch else None


def _by_month(state: TableState, cursor: str) -> bool:
    monthly = f"/{month_layout(cursor)}/{PART}="
    return all(monthly in path for path in state.folders.values())


def changed_months(
    wh: Warehouse, spec: TableSpec, made_of: MadeOf | None, first_day: date, end: date
) -> set[int] | None:
    """Months whose quotes, or whose days in the calendar, have changed since; None: all.

    ``end`` is the first day the calendar doesn't cover.
    """
    now = wh.state(spec.layer, spec.name)
    then = wh.state(spec.layer, spec.name, made_of.raw) if made_of else None
    if now is None or then is None:
        return None
    if not (_by_month(now, spec.cursor) and _by_month(then, spec.cursor)):
        return None
    parts = {*now.folders, *then.folders}
    changed = {int(p) for p in parts if now.folders.get(p) != then.folders.get(p)}
    if (made_of.first_day, made_of.end) != (first_day.isoformat(), end.isoformat()):
        bounds = [first_day, end, date.fromisoformat(made_of.first_day), date.fromisoformat(made_of.end)]
        starts, ends = (bounds[0], bounds[2]), (bounds[1], bounds[3])
        # Months that both calendars cover whole stay as they are.
        low, high = max(starts), min(ends)
        changed |= {
            int(p)
            for p in parts
            if int(p) <= low.year * 100 + low.month or int(p) >= high.year * 100 + high.month
        }
    return changed - {0}  # quotes without a date are in no mart


def following_months(old: DataFrame, new: DataFrame, changed: set[int]) -> set[int]:
    """Months that begin with another quote than before: of pairs whose close in a
    changed month is another one, gone or new, that of their next quote.

    ``old`` and ``new`` are the closes before and after the change. One number per month
    reaches the driver.
    """
    close = [*PAIR, "mes", "fecha", "cotizacion"]
    inside = month_of("mes").isin(sorted(changed))
    sides = old.filter(inside).select(*close, F.lit(1).alias("n"))
    sides = sides.union(new.filter(inside).select(*close, F.lit(-1)))
    other = sides.groupBy(*close).agg(F.sum("n").alias("n")).filter("n <> 0")
    other = other.select(*PAIR, "mes").distinct().withColumn("is_other", F.lit(True))
    known = new.select(*PAIR, "mes", F.lit(False).alias("is_other")).union(other)
    known = known.groupBy(*PAIR, "mes").agg(F.max("is_other").alias("is_other"))
    following = F.lead("mes").over(Window.partitionBy(*PAIR).orderBy("mes"))
    steps = known.withColumn("following", following).filter("is_other AND following IS NOT NULL")
    return {r[0] for r in steps.select(month_of("following")).distinct().collect()}


def quotes_of(wh: Warehouse, spec: TableSpec, months: set[int] | None) -> DataFrame:
    """Raw rows of the given months, from their folders only; all rows if None."""
    if months is None:
        return wh.read(spec.layer, spec.name)
    state = wh.state(spec.layer, spec.name)
    folders = [state.folders[str(m)] for m in sorted(months) if str(m) in state.folders]
    return wh.read_folders(state.schema, folders)
