"""Type-2 history of slowly changing attributes (I5), ``check`` strategy.

Stepwise form (``snapshot_step``): one snapshot run compares the source (one row per key) with the
versions of the target that reach beyond the run's time and
- closes the version of that time and inserts a new one when a checked column IS DISTINCT FROM it,
- inserts a first version for a new key,
- leaves vanished keys open (no hard delete).

Runs may come in any order and more than once. A run that falls into closed history splits the version it falls into,
or moves the start of the next one that has its values; a run whose time is in the table's log changes nothing. For that
a version knows when its values were seen: ``dbt_last_seen``, and ``dbt_missed``, the runs before it that did not have the
key. So the result equals the closed form for the runs so far. Columns that are not checked are those of
the run that started a version; where a version is split, its second part keeps those of the first.

Closed form (``history``): over all runs at once, a version starts at the first run of a key and at
every run whose checked values differ from the key's previous run (gaps and islands with ``lag``),
and ends where the next version starts (``lead``). Both windows are partitioned by key over one row
per (key, run), so a partition holds at most #runs rows whatever the data volume.

Validity columns: ``dbt_scd_id`` = md5(key '|' run time), ``dbt_updated_at`` = ``dbt_valid_from`` =
run time, ``dbt_valid_to`` = null while open.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.sinks.tables import VersionedTable


def _distinct(a_cols, b_cols) -> Column:
    return reduce(lambda x, y: x | y, [~a.eqNullSafe(b) for a, b in zip(a_cols, b_cols)])


def _meta(df: DataFrame, key: str, run_ts: Column) -> DataFrame:
    ts = run_ts.cast("timestamp_ntz")
    return (df.withColumn("dbt_scd_id", F.md5(F.concat_ws("|", F.col(key).cast("string"), ts.cast("string"))))
            .withColumn("dbt_updated_at", ts)
            .withColumn("dbt_valid_from", ts)
            .withColumn("dbt_valid_to", F.lit(None).cast("timestamp_ntz")))


def latest_per_key(df: DataFrame, key_cols, value_cols, order_cols) -> DataFrame:
    """One source row per key: the values of the key's last row in ``order_cols`` order (a combinable
    ``max_by`` aggregate; resolves a mid-season mover to the latest team)."""
    order = F.struct(*[F.col(c) for c in order_cols])
    best = F.max_by(F.struct(*[F.col(c) for c in value_cols]), order).alias("_v")
    return df.groupBy(*key_cols).agg(best).select(*key_cols, *[F.col(f"_v.{c}").alias(c) for c in value_cols])


#: What a stored version knows beyond its contract columns; see ``versions``.
SEEN = ("dbt_last_seen", "dbt_missed")


def versions(target: VersionedTable) -> DataFrame:
    """The stored versions in the contract's columns."""
    return target.read().drop(*SEEN)


def _array(times: list[datetime]) -> Column:
    return F.array(*[F.lit(t).cast("timestamp_ntz") for t in times]).cast("array<timestamp_ntz>")


def snapshot_step(target: VersionedTable, source: DataFrame, key: str, check_cols, run_ts: Column) -> None:
    """Apply one snapshot run to ``target`` (created on the first run). ``source`` has one row per key.

    When the target is partitioned by ``dbt_valid_to`` only versions that end after the run take part, by partition
    pruning: for the latest run the open ones (the null partition). The run replaces those partitions and adds the
    versions it closes under its own. History closed before is never read or rewritten, so a run in
    order costs the number of open versions, a late one also those closed since. The runs so far, one each per
    calendar step, are the notes of the target's log.
    """
    at = target.spark.range(1).select(run_ts.cast("timestamp_ntz")).first()[0]
    runs = sorted({datetime.fromisoformat(n) for n in target.notes()})
    if at in runs:
        return
    ts, none = F.lit(at).cast("timestamp_ntz"), _array([])
    first = _meta(source, key, ts).withColumn(SEEN[0], ts).withColumn(SEEN[1], none)
    if not target.exists():
        target.overwrite(first, note=at.isoformat())
        return

    cur = target.read()
    cols, src_cols = cur.columns, [c for c in cur.columns if not c.startswith("dbt_")]
    before, later = [r for r in runs if r < at], [r for r in runs if r > at]
    ends_after = F.col("dbt_valid_to").isNull() | (F.col("dbt_valid_to") > ts)
    reach = cur.where(ends_after)

    def side(df: DataFrame, name: str, columns) -> DataFrame:
        return df.select(F.struct(*columns).alias(name), F.col(key).alias(f"_{name}"))

    j = (side(reach.where(F.col("dbt_valid_from") <= ts), "c", cols)
         .join(side(source, "s", src_cols), F.col("_c").eqNullSafe(F.col("_s")), "full_outer")  # a null key is a key
         .withColumn("_k", F.when(F.col("c").isNull(), F.col("_s")).otherwise(F.col("_c"))))
    others = None
    if later:  # only then can a version start after the run
        place = F.row_number().over(Window.partitionBy(key).orderBy("dbt_valid_from"))
        after = reach.where(F.col("dbt_valid_from") > ts).withColumn("_place", place)
        others = after.where("_place > 1").select(*cols)
        j = j.join(side(after.where("_place = 1"), "n", cols), F.col("_k").eqNullSafe(F.col("_n")), "full_outer")
    else:
        j = j.withColumn("n", F.lit(None).cast(reach.select(F.struct(*cols).alias("n")).schema["n"].dataType))

    def version(row: str, start: Column, end: Column, seen: Column, missed: Column) -> Column:
        """A version with the source columns of the struct ``row``."""
        scd_id = F.md5(F.concat_ws("|", F.col(f"{row}.{key}").cast("string"), start.cast("string")))
        made = {"dbt_scd_id": scd_id, "dbt_updated_at": start, "dbt_valid_from": start, "dbt_valid_to": end, SEEN[0]: seen, SEEN[1]: missed}
        return F.struct(*[(made[c] if c in made else F.col(f"{row}.{c}")).alias(c) for c in cols])

    def same(a: str, b: str) -> Column:
        return ~_distinct([F.col(f"{a}.{c}") for c in check_cols], [F.col(f"{b}.{c}") for c in check_cols])

    def seen_at(times: Column, test) -> Column:
        return F.filter(times, lambda r: test(r) & (r <= F.col(f"c.{SEEN[0]}")) & ~F.array_contains(F.col(f"c.{SEEN[1]}"), r))

    no_end = F.lit(None).cast("timestamp_ntz")
    c_from, c_to, c_seen, c_missed = (F.col(f"c.{c}") for c in ("dbt_valid_from", "dbt_valid_to", *SEEN))
    n_from, n_to, n_seen, n_missed = (F.col(f"n.{c}") for c in ("dbt_valid_from", "dbt_valid_to", *SEEN))
    resumes = F.array_min(seen_at(_array(later), lambda r: r > ts))
    seen_before = F.array_max(seen_at(_array(before), lambda r: r >= c_from))

    def c_as(start=c_from, end=c_to, seen=c_seen, missed=c_missed) -> Column:
        return version("c", start, end, seen, missed)

    # the run's own version up to ``end``; or the next one, begun earlier, where it has the run's values
    unseen = F.filter(_array(later), lambda r: r < n_from)
    moved = version("s", ts, n_to, n_seen, F.array_sort(F.array_union(n_missed, unseen)))
    next_ = F.when(F.col("n").isNotNull(), F.array(F.col("n"))).otherwise(F.array().cast(f"array<{j.schema['n'].dataType.simpleString()}>"))

    def begun(end: Column) -> Column:
        return (F.when(F.col("n").isNotNull() & same("s", "n"), F.array(moved))
                .otherwise(F.concat(F.array(version("s", ts, end, ts, none)), next_)))

    absent = F.when(ts < c_seen, c_as(missed=F.array_sort(F.array_union(c_missed, F.array(ts))))).otherwise(c_as())
    again = c_as(seen=F.greatest(c_seen, ts), missed=F.when(ts > c_seen, F.concat(c_missed, F.filter(_array(before), lambda r: r > c_seen))).otherwise(c_missed))
    split = F.concat(F.array(c_as(end=ts, seen=seen_before, missed=F.filter(c_missed, lambda r: r < seen_before)), version("s", ts, resumes, ts, none),
                             c_as(start=resumes, missed=F.filter(c_missed, lambda r: r > resumes))), next_)
    result = (F.when(F.col("s").isNull() & F.col("c").isNull(), next_)
              .when(F.col("s").isNull(), F.concat(F.array(absent), next_))
              .when(F.col("c").isNull(), begun(F.when(F.col("n").isNotNull(), n_from).otherwise(no_end)))
              .when(same("c", "s"), F.concat(F.array(again), next_))
              .when(resumes.isNotNull(), split)
              .otherwise(F.concat(F.array(c_as(end=ts)), begun(c_to))))
    new = j.select(F.explode(result).alias("v")).select("v.*")
    new = new if others is None else new.unionByName(others)
    if target.partition_by == ["dbt_valid_to"]:
        target.replace_partitions(new, [None, *later], note=at.isoformat())
    else:
        target.overwrite(cur.where(~ends_after).unionByName(new), note=at.isoformat())


def history(runs: DataFrame, key: str, check_cols, run_col: str, run_ts: Column) -> DataFrame:
    """All versions from a table of (run, key, columns...) with one row per (key, run)."""
    w = Window.partitionBy(key).orderBy(F.col(run_col))
    first = F.row_number().over(w) == 1
    changed = _distinct([F.lag(c).over(w) for c in check_cols], [F.col(c) for c in check_cols])
    starts = (runs.withColumn("_ts", run_ts.cast("timestamp_ntz")).withColumn("_start", first | changed)
              .where(F.col("_start")).drop("_start"))
    w2 = Window.partitionBy(key).orderBy(F.col("_ts"))
    out = _meta(starts, key, F.col("_ts")).withColumn("dbt_valid_to", F.lead("_ts").over(w2))
    return out.drop("_ts", run_col)


def current(versions: DataFrame) -> DataFrame:
    return versions.where(F.col("dbt_valid_to").isNull())
