"""Tables whose versions appear atomically (K1-K3, K6, I4, I6; traps T10-T12).

A ``VersionedTable`` is a folder of immutable Parquet *parts* plus an append-only commit log
(``_commits``, itself Parquet). A commit is one row: the part it adds and the partition values it takes
from the parts before it (``overwrite`` takes everything). A part becomes visible only when its
commit row is appended after the part's Spark job; a failed run leaves the previous version, and no
path that is being read is ever written to (T12). The log grows by one row a commit.

- ``append`` writes only the new rows; ``replace_partitions`` (season replace, I6) writes only the
  replacement and hides the replaced partition values in older parts, by a partition filter that
  prunes their files. ``compact`` rewrites everything once into a single part.
- Parts are ``vt_part=<id>`` folders under the table; a read scans the live ones as one relation.
- Files are written by partition value after a rebalance on it, so that a value has a few files of
  fair size, and a large value is split over several tasks. A table with ``order_by`` is range-partitioned on its
  partition column and those columns instead, and sorted after that exchange: the files of a value hold ranges that
  follow each other, each in order, so that Parquet statistics skip files and row groups (O1).
- A commit may carry a ``note`` of its writer, and aggregates of the rows that its job wrote (``observe``),
  collected by that job. Neither is interpreted here.

Columns are bound by name on every write (T10). One writer per table at a time.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.session import path_exists

_LOG_SCHEMA = ("version INT, op STRING, part STRING, hidden ARRAY<STRING>, table_schema STRING, partition_by ARRAY<STRING>,"
               " note STRING, observed MAP<STRING, BIGINT>")

# Folder prefix of a part; read back as a partition column and dropped.
_PART_COL = "vt_part"

# Partition values are hidden by their text form; a null value gets a marker no text cast produces.
_NULL_MARK = "\u0000null"


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str, partition_by=(), order_by=()):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_by = list(partition_by)
        self.order_by = list(order_by)
        self._log_rows = None  # the log as last seen by this writer (one writer per table)

    # -- log -------------------------------------------------------------------------------------
    @property
    def _log(self) -> str:
        return f"{self.path}/_commits"

    def commits(self) -> list:
        """The commits since the last overwrite, oldest first; empty when the table does not exist. Any
        failure to read a log that is there is an error, never an empty table."""
        if self._log_rows is None:
            self._log_rows = self._current(self._whole_log())
        return self._log_rows

    def _whole_log(self) -> list:
        if not path_exists(self.spark, self._log):
            return []
        return self.spark.read.schema(_LOG_SCHEMA).parquet(self._log).orderBy("version").collect()

    def notes(self) -> list[str]:
        """The notes of all commits ever, oldest first, also of those before the last overwrite."""
        return [r.note for r in self._whole_log() if r.note is not None]

    @staticmethod
    def _current(rows: list) -> list:
        last = max((i for i, r in enumerate(rows) if r.op == "overwrite"), default=0)
        return rows[last:]

    def exists(self) -> bool:
        return bool(self.commits())

    def version(self) -> int:
        log = self.commits()
        return log[-1].version if log else 0

    def _commit(self, op: str, part: tuple[str, dict], hidden, schema: T.StructType, note: str | None = None) -> None:
        name, observed = part
        row = (self.version() + 1, op, name, list(hidden), schema.json(), self.partition_by, note, observed)
        commit = self.spark.createDataFrame([row], _LOG_SCHEMA)
        commit.coalesce(1).write.mode("append").parquet(self._log)
        self._log_rows = self._current([*self.commits(), commit.first()])

    # -- read ------------------------------------------------------------------------------------
    def schema(self) -> T.StructType:
        log = self.commits()
        if not log:
            raise FileNotFoundError(f"no table at {self.path}")
        return T.StructType.fromJson(json.loads(log[-1].table_schema))

    def _scan(self, parts, schema: T.StructType | None = None) -> DataFrame:
        """The rows of ``parts`` in one scan, with the part id as a partition column."""
        fields = self.schema().fields if self.exists() else schema.fields
        read_schema = T.StructType([*fields, T.StructField(_PART_COL, T.StringType())])
        return (self.spark.read.schema(read_schema).option("basePath", self.path)
                .parquet(*[f"{self.path}/{_PART_COL}={p}" for p in parts]))

    def read(self) -> DataFrame:
        """All live rows in one scan. A row is live if no later commit took its partition value: one filter on partition
        columns, with an entry for each value that was ever replaced, however many commits there are."""
        schema, log = self.schema(), self.commits()
        df = self._scan([c.part for c in log])
        since = {v: c.part for c in log[1:] for v in c.hidden}  # names of parts sort as their commits
        if since:
            taken = F.create_map(*[F.lit(x) for pair in since.items() for x in pair])
            df = df.where(F.col(_PART_COL) >= F.coalesce(F.try_element_at(taken, _partition_key(log[-1].partition_by)), F.lit("")))
        return df.select(*schema.fieldNames())

    def read_placed(self, file: str = "_file", row: str = "_row") -> DataFrame:
        """The live rows with the file that holds each and its place in it, from 0."""
        parts = self.read()  # hidden columns of the scan are still reachable below a projection of its columns
        return parts.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))

    def observed_total(self, name: str) -> int | None:
        """What the jobs that wrote the live rows observed under ``name``, summed; None where only a scan can tell: if
        a commit did not observe it, or rows of one that saw some were replaced since."""
        log = self.commits()
        counts = [(c.observed or {}).get(name) for c in log]
        if None in counts or (sum(counts) and any(c.hidden for c in log[1:])):
            return None
        return sum(counts)

    # -- write -----------------------------------------------------------------------------------
    def _write_part(self, df: DataFrame, observe: dict[str, Column] | None = None, dealt: bool = False, onto: str | None = None) -> tuple[str, dict]:
        """Write ``df`` as a new part: (its name, what the job that wrote it observed). Rows that are ``dealt`` out by
        partition value already are written where they are. ``onto`` a part that no commit names yet, files are added to it."""
        part = onto or f"{self.version() + 1:09d}-{uuid.uuid4().hex}"
        if self.order_by:
            df = df.repartitionByRange(*self.partition_by, *self.order_by)
        elif self.partition_by and not dealt:
            df = df.hint("rebalance", *[F.col(c) for c in self.partition_by])
        seen = Observation() if observe else None
        if seen:  # after the last exchange: a range partitioning also samples what is below it
            df = df.observe(seen, *[c.cast("bigint").alias(n) for n, c in observe.items()])
        if self.order_by:
            df = df.sortWithinPartitions(*self.partition_by, *self.order_by)
        df.write.partitionBy(*self.partition_by).mode("append" if onto else "errorifexists").parquet(f"{self.path}/{_PART_COL}={part}")
        return part, dict(seen.get) if seen else {}

    def _bind(self, df: DataFrame) -> DataFrame:
        if not self.exists():
            return df
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema().fields])

    def create_empty(self, like: DataFrame) -> "VersionedTable":
        """K1: create the table with ``like``'s schema and no rows, only if it does not exist."""
        if not self.exists():
            self._commit("create", self._write_part(like.where(F.lit(False))), [], like.schema)
        return self

    def append(self, df: DataFrame, note: str | None = None, dealt: bool = False) -> "VersionedTable":
        df = self._bind(df)
        self._commit("append", self._write_part(df, dealt=dealt), [], df.schema, note)
        return self

    def overwrite(self, df: DataFrame, note: str | None = None, observe: dict[str, Column] | None = None, dealt: bool = False) -> "VersionedTable":
        self._commit("overwrite", self._write_part(df, observe, dealt), [], df.schema, note)
        return self

    def compact(self) -> "VersionedTable":
        return self.overwrite(self.read())

    def replace_partitions(self, df: DataFrame, values, note: str | None = None, observe: dict[str, Column] | None = None) -> "VersionedTable":
        """``DELETE WHERE partition IN values; INSERT df`` as one commit. ``values`` are values of the
        single partition column (``None`` = the null partition); ``df`` may also hold rows of other
        partitions, which are simply added. An empty ``df`` empties the listed partitions (T11)."""
        if len(self.partition_by) != 1:
            raise ValueError("replace_partitions needs exactly one partition column")
        df = self._bind(df)
        self._commit("replace", self._write_part(df, observe), [_partition_text(v) for v in values], df.schema, note)
        return self

    def upsert(self, batch: DataFrame, key, key_of: Column | None = None, dealt: bool = False) -> "VersionedTable":
        """I4: ``DELETE WHERE key IN batch; INSERT batch`` as one commit, for a table whose key determines
        its (single) partition column. Only the partitions that the batch touches are read and replaced.

        With ``key_of``, the expression of a row's columns, the partition column among them, that every row's key
        equals, the batch is held against it, and no other partition can hold its keys: history is not read. Without
        it, a scan of the other partitions' keys looks for the batch's. A key that breaks the rule raises.

        The batch is written first, as a part that no commit names yet, so it is computed once; the kept
        rows of the touched partitions are added to that part as files of their own, so the batch is not written again. The
        join that finds them reads the part's files listed before."""
        if len(self.partition_by) != 1:
            raise ValueError("upsert needs exactly one partition column")
        keys = [key] if isinstance(key, str) else list(key)
        if key_of is not None and len(keys) != 1:
            raise ValueError("key_of is the expression of one key column")
        part = self._write_part(self._bind(batch), dealt=dealt)
        written = self._scan([part[0]], batch.schema).drop(_PART_COL)
        if key_of is not None and not written.where(~F.col(keys[0]).eqNullSafe(key_of)).isEmpty():
            raise ValueError("a key of the batch is not that of its row")
        if not self.exists():
            self._commit("overwrite", part, [], batch.schema)
            return self
        # one row per partition value (season) of the batch
        touched = [r[0] for r in written.select(_partition_key(self.partition_by)).distinct().collect()]
        inside = _partition_key(self.partition_by).isin(touched)
        ids = written.select(*keys).distinct()
        if key_of is None and not self.read().where(~inside).select(*keys).join(ids, keys, "left_semi").isEmpty():
            raise ValueError("a key of the batch is in the table under another partition value")
        keep = self.read().where(inside).join(ids, keys, "left_anti")
        if self.order_by:  # the files of a value follow each other in order: kept and new rows go into one part
            merged = self._bind(keep.unionByName(written))
            self._commit("upsert", self._write_part(merged), touched, merged.schema)
        else:
            kept = self._bind(keep)
            self._commit("upsert", self._write_part(kept, onto=part[0]), touched, kept.schema)
        return self


def _partition_text(v) -> str:
    if v is None:
        return _NULL_MARK
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    return str(v)


def _partition_key(cols):
    (c,) = cols
    return F.coalesce(F.col(c).cast("string"), F.lit(_NULL_MARK))


def export_csv(df: DataFrame, path: str) -> None:
    """K4: header CSV, comma separated, quotes escaped by doubling (T13: empty text reads back null)."""
    df.write.mode("errorifexists").option("header", True).option("escape", '"').csv(path)
