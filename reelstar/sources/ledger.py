"""Load numbers: which commit brought a row, and how far a table has read.

Every write of a logged table is a *load*: it gets the next number before it
writes (``<n>.begin``), its rows carry the number, and it counts once its entry
(``<n>.json``) is there - put beside and renamed, so an entry is whole or not
there.  Numbers are never given twice.  A load that died is left with a number
and no entry; its rows are not read.

An entry says what the load did (``op``: append or replace), the days
(partition values) its rows lie in, their number, and ``upto``: per source the
last load of it that is in the table now.  An increment is therefore a range of
load numbers of the source: it does not depend on the time stamps of the rows, on
their keys, or on when a refresh happens to run.

One small file per load in ``<store>/_ledger/<table>``; a refresh lists the names
and opens the entries after its position only.
"""

from __future__ import annotations

import datetime as _dt
import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import Files

#: Columns that logged tables have besides their own.
LOAD, LOAD_DATE = "load_id", "load_date"
#: Seconds after which a load without an entry counts as dead.
ABANDONED_S = 24 * 3600


class Ledger:
    def __init__(self, spark: SparkSession, root: str):
        self.files, self.root = Files(spark), root.rstrip("/")

    def _names(self, table: str) -> dict[str, float]:
        return self.files.names(f"{self.root}/{table}")

    def _read(self, table: str, load: int) -> dict:
        return json.loads(self.files.read(f"{self.root}/{table}/{load:019d}.json"))

    # -- loads -------------------------------------------------------------------
    def begin(self, table: str, sole_writer: bool = False) -> int:
        """The number of a new load.  A sole writer declares the loads it finds
        open dead: nobody else can be at work on them."""
        names = self._names(table)
        if sole_writer:
            for dead in self.loads(table)[1]:
                if f"{dead:019d}.void" not in names:
                    self.files.create(f"{self.root}/{table}/{dead:019d}.void", "")
        load = max((int(n.split(".")[0]) for n in names if n[0].isdigit()), default=0) + 1
        while True:
            try:
                self.files.create(f"{self.root}/{table}/{load:019d}.begin", "")
                return load
            except FileExistsError:
                load += 1  # another writer took it meanwhile

    def commit(self, table: str, load: int, entry: dict) -> None:
        """Make the load count; its ``upto`` carries on that of the last entry."""
        if f"{load:019d}.void" in self._names(table):
            raise OSError(f"load {load} of {table} was given up by another writer")
        last = self.last(table)
        upto = {**((last or {}).get("upto") or {}), **(entry.get("upto") or {})}
        whole = {"op": "append", **entry, "load": load, "upto": upto}
        self.files.put(f"{self.root}/{table}/{load:019d}.json", json.dumps(whole, default=str))

    def loads(self, table: str) -> tuple[list[int], list[int]]:
        """Numbers of the committed loads, and of those without an entry."""
        names = self._names(table)
        done = sorted(int(n[:-5]) for n in names if n[0].isdigit() and n.endswith(".json"))
        begun = {int(n[:-6]) for n in names if n.endswith(".begin")}
        return done, sorted(begun - set(done))

    def settled_loads(self, table: str) -> tuple[int, list[int]]:
        """The number up to which every load has come to its end (a reader that
        went past an open one would miss its rows), and the dead ones below.  A
        load that has been open for ``ABANDONED_S`` seconds is dead."""
        found = self._names(table)
        begun = {int(n[:-6]): t for n, t in found.items() if n.endswith(".begin")}
        latest, dead = 0, []
        for load in sorted(begun):
            if f"{load:019d}.json" not in found:
                if f"{load:019d}.void" not in found and time.time() - begun[load] < ABANDONED_S:
                    break
                dead.append(load)
            latest = load
        return latest, dead

    def entries(self, table: str, after: int = 0, last: int | None = None) -> list[dict]:
        """Entries of the committed loads after a number, up to ``last``."""
        return [self._read(table, n) for n in self.loads(table)[0] if n > after and (last is None or n <= last)]

    def last(self, table: str) -> dict | None:
        done = self.loads(table)[0]
        return self._read(table, done[-1]) if done else None

    def position(self, table: str, source: str) -> int | None:
        """The last load of ``source`` that is in the table; None: none known."""
        last = self.last(table)
        return (last or {}).get("upto", {}).get(source)


@dataclass
class Loads:
    """A source whose rows carry their load number in ``load_id``."""

    rows: DataFrame
    latest: int
    #: entries of the loads after a number, oldest first
    entries: Callable[[int], list[dict]]
    #: date column that the days of the entries belong to, if the source has one
    day_col: str | None = None
    hidden: list[int] = field(default_factory=list)

    def whole(self) -> DataFrame:
        """The rows of all committed loads."""
        rows = self.rows.filter(F.col(LOAD) <= self.latest) if self.latest else self.rows.filter("false")
        return rows.filter(~F.col(LOAD).isin(self.hidden)) if self.hidden else rows

    def since(self, after: int | None) -> DataFrame:
        """The rows that loads after number ``after`` appended; all rows for None.

        Only the days these loads wrote to are listed, and Parquet statistics on
        the load number skip older files in them.  A load that replaced the table
        brought no new rows: what it holds was there before.
        """
        if after is None:
            return self.whole()
        new = self.entries(after)
        if not new:
            return self.rows.filter("false")
        rows = self.whole().filter(F.col(LOAD) > after)
        replaced = [e["load"] for e in new if e["op"] == "replace"]
        if replaced:
            rows = rows.filter(~F.col(LOAD).isin(replaced))
        days = days_of(new) if self.day_col else None
        if days is not None:
            rows = rows.filter(among(F.col(self.day_col), days))
        return rows


def days_of(entries: list[dict]) -> list[_dt.date | None] | None:
    """The days the loads wrote to (None among them: rows without a day), or
    None if some load does not say."""
    if any(e.get("days") is None for e in entries):
        return None
    days = {d for e in entries for d in e["days"]}
    return sorted((None if d is None else _dt.date.fromisoformat(d) for d in days), key=lambda d: (d is not None, d))


def among(col: F.Column, days: list[_dt.date | None]) -> F.Column:
    """A static filter on a date column; None stands for NULL."""
    dated = [F.lit(d) for d in days if d is not None]
    cond = col.isin(dated) if dated else F.lit(False)
    return cond | col.isNull() if None in days else cond
