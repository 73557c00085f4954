"""Gold in step with Bronze by signed counts (``operators.deltas``), kept in three small catalog tables.

A load stages its changes (new versions +1, replaced versions -1) before Bronze is switched, and adds them as one
partition of each table afterwards; after some loads the partitions are folded into a new base. Nothing of
Bronze but the replaced versions is read. A rebuild counts all of Silver once and replaces the base.

The load state names the watermark that the tables are in step with. It is cleared before Bronze changes and
set after the tables did, so a run that dies in between is followed by a rebuild, not by a wrong sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tierwise.operators import deltas
from tierwise.plans import storage


def counts_path(wh: storage.Warehouse, name: str) -> str:
    return wh.path("gold", f"_{name}_counts")


def counts(spark: SparkSession, wh: storage.Warehouse) -> dict[str, DataFrame]:
    """The three tables, each key once."""
    return {n: deltas.merged(n, storage.read_counts(spark, counts_path(wh, n))) for n in deltas.GRAINS}


def mart_counts(spark: SparkSession, wh: storage.Warehouse) -> dict[str, DataFrame]:
    """What the marts are made of: ``daily`` as stored, base and deltas, since its marts sum it by a coarser key anyway;
    the others with each key once."""
    return counts(spark, wh) | {"daily": storage.read_counts(spark, counts_path(wh, "daily"))}


def rebuild(spark: SparkSession, wh: storage.Warehouse, finest: DataFrame, load: int) -> None:
    """New bases from the finest counts of all rows (read three times: pass a staged table)."""
    rolled = deltas.roll_up(finest)
    storage.at_once(spark, [lambda n=n: storage.store_counts(spark, counts_path(wh, n), rolled[n], load, True) for n in rolled])


def add_changes(spark: SparkSession, wh: storage.Warehouse, finest: DataFrame, load: int) -> None:
    """Add a load's signed counts; every ``storage.DELTAS_KEPT`` loads the tables are folded into new bases."""
    rolled = deltas.roll_up(finest)

    def add(name: str) -> None:
        path = counts_path(wh, name)
        fold = len(storage._loads(spark, path)) >= storage.DELTAS_KEPT
        new = deltas.merged(name, storage.read_counts(spark, path), rolled[name]) if fold else rolled[name]
        storage.store_counts(spark, path, new, load, fold)

    storage.at_once(spark, [lambda n=n: add(n) for n in rolled])
