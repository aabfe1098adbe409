"""Staging of complete races from a stream (section 2.14): rows wait in state until their race is marked complete.

Two file streams: landed rows, each with the time it landed (``landed_at``), and markers, one per race, with the number
of rows that make the race complete and the time that closes it (``marked_at``). Both carry a watermark, and a
stream-stream left outer join on the race key brings them together: a row is kept in the state store until
its marker comes, whichever of them is seen first, and leaves it when the watermark says that no marker in time can
come any more. A marker closes what landed up to its time and no longer than ``wait`` before. Repeated
markers count once, within the watermark.

``foreachBatch`` gets rows with their marker. Rows of a race whose number is not reached yet are *held* in a table;
when it is reached the race is staged whole, in one commit, by the staging model's incremental rule. What cannot be
staged goes to the *rejected* table with its reason: ``unmarked`` (no marker in time, or no race key; the join's outer
rows) and ``late`` (of a race that was staged before).

State is keyed by race, so it is spread over the shuffle partitions and holds groups until the watermark has passed
them; ``spark.sql.streaming.stateStore.providerClass`` may name the RocksDB provider where that is more than
executors can hold.

Replay: a micro-batch that died before the stream's checkpoint is delivered again, the same. The commit of the held
table comes last and carries the batch's number; a batch that it names is done and skipped. Before it, the steps
are repeatable: the ledger of staged races and the rejected rows replace the batch's own partition, and
the incremental rule finds the races that are staged already.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.functions.columns import race_id
from paddock.operators import incremental as inc
from paddock.session import stored
from paddock.sinks.tables import VersionedTable

RACE = ["year", "round"]
MARKERS = T.StructType([T.StructField("year", T.IntegerType()), T.StructField("round", T.IntegerType()),
                        T.StructField("expected", T.LongType()), T.StructField("marked_at", T.TimestampType())])


def landed_schema(rows: T.StructType) -> T.StructType:
    """The rows' schema with the time of landing."""
    return T.StructType([*rows.fields, T.StructField("landed_at", T.TimestampType())])


#: Groups that a task gathers before it passes them on.
GATHERED = 100_000


def _distinct_rows(batches):
    """The distinct rows of a task's Arrow batches; those of each ``GATHERED`` where there are more."""
    seen = None
    for batch in batches:
        new = pa.Table.from_batches([batch])
        seen = (new if seen is None else pa.concat_tables([seen, new])).group_by(new.column_names).aggregate([])
        if seen.num_rows > GATHERED:
            yield from seen.to_batches()
            seen = None
    if seen is not None:
        yield from seen.to_batches()


class MarkedRaces:
    """A landing (``rows``, ``markers``) and what is made of it, under one folder."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, wait: str = "7 days"):
        self.spark, self.root, self.schema, self.wait = spark, root.rstrip("/"), schema, wait
        self.rows_dir, self.markers_dir = f"{self.root}/landing/rows", f"{self.root}/landing/markers"
        self.target = VersionedTable(spark, f"{self.root}/staged", ["season_year"])
        self.held = VersionedTable(spark, f"{self.root}/held")
        self.ledger = VersionedTable(spark, f"{self.root}/ledger", ["batch"])
        self.rejected = VersionedTable(spark, f"{self.root}/rejected", ["batch"])

    def groups(self) -> DataFrame:
        """The stream of groups of landed rows, each once per task that reads its file."""
        rows = self.spark.readStream.schema(landed_schema(self.schema)).parquet(self.rows_dir)
        rows = rows.select(F.col("_metadata.file_path").alias("file"), *RACE, "landed_at")
        return rows.mapInArrow(_distinct_rows, rows.schema)

    def joined(self) -> DataFrame:
        """Groups with their marker's number of rows; null where no marker came in time."""
        groups = self.groups().withWatermark("landed_at", self.wait)
        markers = (self.spark.readStream.schema(MARKERS).parquet(self.markers_dir).withWatermark("marked_at", self.wait)
                   .dropDuplicatesWithinWatermark(RACE).select(*[F.col(c).alias(f"m_{c}") for c in RACE], "expected", "marked_at"))
        wait = F.expr(f"INTERVAL {self.wait}")
        on = [F.col(c) == F.col(f"m_{c}") for c in RACE]
        return (groups.join(markers, [*on, F.col("landed_at") <= F.col("marked_at"), F.col("landed_at") >= F.col("marked_at") - wait], "left_outer")
                .drop("m_year", "m_round", "marked_at"))

    def rows_of(self, groups: DataFrame) -> DataFrame:
        """The landed rows of ``groups``, with their marker's number of rows; only the files of the groups are read."""
        groups = stored(groups.distinct(), "marked-groups")
        files = [r.file for r in groups.select("file").distinct().collect()]
        key = ["file", *RACE, "landed_at"]
        groups = groups.select(*[F.col(c).alias(f"g_{c}") for c in key], "expected")
        rows = self.spark.read.schema(landed_schema(self.schema)).parquet(self.rows_dir)
        rows = rows.where(F.col("_metadata.file_path").isin(files)).select("*", F.col("_metadata.file_path").alias("file"))
        return (rows.join(groups, [F.col(c).eqNullSafe(F.col(f"g_{c}")) for c in key])
                .select(*self.schema.fieldNames(), "landed_at", "expected"))

    def apply(self, batch: DataFrame, number: int, stage) -> None:
        """One micro-batch: rows with their marker's number of rows (``rows_of`` what ``joined`` lets out)."""
        done = self.held.commits()[-1].note if self.held.exists() else None
        if done is not None and int(done) >= number:
            return
        fresh = stored(batch, "marked-batch")
        if fresh.isEmpty():
            return
        marked = fresh.where("expected IS NOT NULL")
        waiting = marked.unionByName(self.held.read()) if self.held.exists() else marked
        waiting = waiting.withColumn("_race", race_id(*RACE))
        staged = self.ledger.read().where(F.col("batch") < number).select("_race") if self.ledger.exists() else waiting.select("_race").where("false")
        staged = stored(staged, "staged-races")  # one row per race: its size plans the joins
        late, open_ = (waiting.join(staged, "_race", how) for how in ("left_semi", "left_anti"))

        complete = open_.groupBy("_race", "expected").agg(F.count("*").alias("n")).where("n >= expected").select("_race")
        complete = stored(complete.distinct(), "complete-races")
        self._own(self.ledger, complete.withColumn("batch", F.lit(number)), number)
        names = self.schema.fieldNames()
        whole = open_.join(complete, "_race", "left_semi").select(*names)
        if not whole.isEmpty():
            inc.incremental_stage(self.target, whole, stage, race_id(*RACE), dealt_by=RACE[0])
        refused = (late.select(*names, "landed_at").withColumn("reason", F.lit("late"))
                   .unionByName(fresh.where("expected IS NULL").select(*names, "landed_at").withColumn("reason", F.lit("unmarked"))))
        self._own(self.rejected, refused.withColumn("batch", F.lit(number)), number)
        rest = open_.join(complete, "_race", "left_anti").drop("_race")
        self.held.overwrite(rest.select(*fresh.columns), note=str(number))

    @staticmethod
    def _own(table: VersionedTable, rows: DataFrame, number: int) -> None:
        rows = rows.withColumn("batch", F.col("batch").cast("int"))
        if table.exists():
            table.replace_partitions(rows, [number])
        else:
            table.overwrite(rows)

    def trigger(self, stage) -> None:
        """Process what has landed, then stop."""
        query = (self.joined().writeStream.foreachBatch(lambda batch, number: self.apply(self.rows_of(batch), number, stage))
                 .option("checkpointLocation", f"{self.root}/_checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
