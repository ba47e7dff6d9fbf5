"""The states of ``operators.lattice`` kept on disk and maintained.

An update writes one folder per kind of state, for all snapshots it reads, and
then a list of them: (snapshot, signature, run). The signature is made of the
names of the snapshot's History files, which change when the snapshot is
written again. So an update reads the History of the snapshots whose signature
is not listed, and merges what is stored for the others. Nothing is ever
overwritten: states of an older signature, or of an update that died before
its list was written, are not in the list that readers join.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from immolens.operators.lattice import DATE, STATES
from immolens.schema import HISTORY
from immolens.sources.files import _read_or_empty, read_history
from immolens.sources.footers import snapshot_files

LISTED = f"{DATE} date, signature string, run string"


@dataclass
class States:
    """Current states, by kind; the snapshots' dates, in order, without a null
    one; and the dates whose History was read for this update."""

    market: DataFrame
    price: DataFrame
    deals: DataFrame
    listing: DataFrame
    snapshots: list[dt.date]
    updated: list[dt.date | None]


def dated(dates) -> Column:
    """Rows of some snapshots (a null date is one)."""
    known = [d for d in dates if d is not None]
    within = F.col(DATE).isin(known) if known else F.lit(False)
    return within | F.col(DATE).isNull() if None in dates else within


def _signatures(history: DataFrame) -> dict[dt.date | None, str]:
    return {date: hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()
            for date, files in snapshot_files(history).items()}


def _listed(spark: SparkSession, root: str) -> dict[tuple[dt.date | None, str], str]:
    """The run that made the states of each (snapshot, signature); one row a
    snapshot and rewrite reaches the driver."""
    schema = spark.createDataFrame([], LISTED).schema
    rows = _read_or_empty(spark, schema, lambda: spark.read.schema(schema).option("basePath", f"{root}/listed").parquet(f"{root}/listed"))
    return {(r[DATE], r["signature"]): r["run"] for r in rows.orderBy("run").collect()}


def update_states(spark: SparkSession, history: str | DataFrame, root: str) -> States:
    """Brings the states under ``root`` up to date with a history (its folder,
    or a plain read of its files) and returns them. Of the History only new
    and rewritten snapshots are read."""
    root = root.rstrip("/")
    if isinstance(history, str):
        history = read_history(spark, history)
    current, listed = _signatures(history), _listed(spark, root)
    stale = [d for d, s in current.items() if (d, s) not in listed]
    if stale:
        run = uuid.uuid4().hex
        rows = history.where(dated(stale))
        for name, build in STATES.items():
            build(rows).write.parquet(f"{root}/{name}/run={run}")
        (spark.createDataFrame([(d, current[d]) for d in stale], f"{DATE} date, signature string").coalesce(1)
         .write.parquet(f"{root}/listed/run={run}"))
        listed.update({(d, current[d]): run for d in stale})
    used = {d: listed[d, s] for d, s in current.items()}
    return States(**{name: _current(spark, root, name, used) for name in STATES},
                  snapshots=sorted(d for d in current if d is not None), updated=stale)


def _current(spark: SparkSession, root: str, name: str, used: dict[dt.date | None, str]) -> DataFrame:
    """The rows of one kind of state that the list names: (snapshot, run)."""
    empty = STATES[name](spark.createDataFrame([], HISTORY))
    if not used:
        return empty
    schema = T.StructType([*empty.schema.fields, T.StructField("run", T.StringType())])
    rows = spark.read.schema(schema).option("basePath", f"{root}/{name}").parquet(f"{root}/{name}")
    wanted = F.broadcast(spark.createDataFrame(list(used.items()), "_date date, _run string"))      # one row a snapshot
    return (rows.where(F.col("run").isin(sorted(set(used.values()))))
            .join(wanted, F.col(DATE).eqNullSafe(F.col("_date")) & (F.col("run") == F.col("_run")), "left_semi").drop("run"))
