"""Incremental table operators.

``not_in``        SQL ``x NOT IN (SELECT k FROM keys)`` with its null rules (T4), planned as a plain
                  equi left-anti join on distinct keys instead of a null-aware join that Spark can
                  only run as a broadcast (or a nested loop when the key set is not known small).
``append_unseen`` skip rows whose (year, round) is already loaded (ingestion, J4/I7).
``incremental_stage`` the staging rule: first run takes all rows, later runs only rows whose race
                  key is not in the target yet, appended (I1-I3).
``upsert_by_key`` delete target rows whose key is in the batch, then insert the batch (I4).
``first_batch_wins`` the closed form of repeated incremental runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paddock.session import stored
from paddock.sinks.tables import VersionedTable


def not_in(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` where ``column NOT IN (SELECT key FROM keys)`` is true.

    SQL three-valued logic: with an empty key set every row passes (null included); with a null in
    the key set no row passes; otherwise null probes are dropped and the rest is an anti join. The distinct
    keys (one row per race for the staging tables) are written once: the two facts about them are one
    small aggregate, and their file size lets the optimizer broadcast them when they are small instead
    of shuffling the rows on a few hundred keys; a large key set is a sort-merge anti join.
    """
    k = stored(keys.select(F.col(key).alias("_k")).distinct(), "keys")
    r = k.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_k").isNull()).alias("nulls")).first()
    if r.n == 0:
        return df
    if r.nulls > 0:
        return df.where(F.lit(False))
    return df.where(F.col(column).isNotNull()).join(k, F.col(column) == F.col("_k"), "left_anti")


def append_unseen(target: VersionedTable, landed: DataFrame, keys=("year", "round"), seasons=None,
                  season_col: str = "year") -> DataFrame:
    """Rows of ``landed`` whose ``keys`` are not yet in the target (a missing target = empty set).
    Plain (not null-aware) anti join, like a membership test against a set of loaded rounds. With
    ``seasons`` the run is about those seasons only: rows of others are left for their own run, and
    only those target partitions are read."""
    if seasons is not None:
        landed = landed.where(F.col(season_col).isin(list(seasons)))
    if not target.exists():
        return landed
    loaded = target.read()
    if seasons is not None:
        loaded = loaded.where(F.col(season_col).isin(list(seasons)))
    return landed.join(stored(loaded.select(*keys).distinct(), "rounds"), list(keys), "left_anti")


def incremental_stage(target: VersionedTable, raw: DataFrame, stage, raw_key, target_key: str = "race_id",
                      seasons=None, season_col: str = "season_year", dealt_by: str | None = None) -> DataFrame:
    """One incremental run of a staging model; returns the rows appended.

    ``stage`` maps raw rows to staged rows; ``raw_key`` is the race-key Column on raw rows. Because
    the unique key of every staging model contains the race, rows of a race not yet in the target
    can never match a target key, so the model's delete+insert reduces to an append.

    With ``seasons`` (``raw`` holds only those seasons) the target's keys are read from those season
    partitions only: a race key starts with its season, so keys of other seasons can never match.

    With ``dealt_by``, the column of raw rows that becomes the target's partition, the raw rows are dealt out by it and
    staged where they are written: the keys that staging adds are not shuffled.
    """
    if target.exists():
        existing = target.read()
        if seasons is not None:
            existing = existing.where(F.col(season_col).isin(list(seasons)))
        raw = raw.withColumn("_race_key", raw_key)
        raw = not_in(raw, "_race_key", existing.select(target_key), target_key).drop("_race_key")
    batch = stage(raw if dealt_by is None else raw.hint("rebalance", F.col(dealt_by)))
    target.append(batch, dealt=dealt_by is not None)
    return batch


def upsert_by_key(target: DataFrame, batch: DataFrame, key) -> DataFrame:
    """``DELETE FROM target WHERE key IN (SELECT key FROM batch); INSERT batch`` as one DataFrame:
    anti join on the distinct batch keys (the batch is the small side), then union by name."""
    keys = [key] if isinstance(key, str) else list(key)
    keep = target.join(batch.select(*keys).distinct(), keys, "left_anti")
    return keep.unionByName(batch.select(*target.columns))


def upsert_into(target: VersionedTable, batch: DataFrame, key, partition_col: str, key_of=None, dealt: bool = False) -> None:
    """I4 on a partitioned ``VersionedTable`` whose key determines the partition (``result_sk``
    hashes the season): only the partitions the batch touches are read, merged and replaced, in one
    commit, and the batch itself is computed once. ``key_of`` is the key's expression over the row's columns, which
    proves the rule from the batch alone (see ``VersionedTable.upsert``); ``dealt`` as in ``VersionedTable.append``."""
    if target.partition_by != [partition_col]:
        raise ValueError(f"target must be partitioned by {partition_col}")
    target.upsert(batch, key, key_of, dealt)


def first_batch_wins(df: DataFrame, race_key: str, batch_col: str) -> DataFrame:
    """Closed form of repeated incremental runs: a row stays iff it arrived in the first batch that
    carried its race. Grouped min + join (combinable map-side) rather than a window over the race,
    so a race holding a third of all rows does not land in one task."""
    first = df.groupBy(F.col(race_key).alias("_rk")).agg(F.min(batch_col).alias("_first"))
    return (df.join(first, F.col(race_key).eqNullSafe(F.col("_rk")))
            .where(F.col(batch_col) == F.col("_first")).drop("_first", "_rk"))
