"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks; DataFrame functions only.

Targets: sources in code point order (null last) weigh ``weights``, repeating, and share all words; a target stops at
``most`` times its source's words, and the excess goes to the others by weight. The fixed point is found by filling
in the order of limit / weight.

Schedule: the mix is a sequence of slots of ``BLOCK`` words. Slot i lies at the i-th point of the golden-ratio sequence,
and the source whose stretch of the cumulative targets holds that point gets the slot, so that every stretch of the
sequence is close to the targets. Each source's documents, shuffled by hash, form one stream of words cut into blocks
(a block may hold parts of documents); a slot's rank among its source's slots, modulo the source's number of blocks,
names the block that it takes, so a source is taken round by round. A source's target, in whole words, says how many
slots it needs and how many words the last of them takes: slots beyond that take nothing, and what the points
have not given yet is given by slots at the end of the mix. So every source, whatever its size, takes its target to the word, and
no document more than ``most`` times.

The points are computed in integers, the upper 31 bits of a 62-bit golden step, which lie evenly at any length, and the
shuffle by md5, so that reruns agree everywhere. Ranks and stream positions come from counts per piece (a run of slots,
a range of hashes) and a running sum over those, so that no window holds a source; rows that repeat id and text are one
entry per input partition, spread again before they are told apart. Nothing but the total number of words reaches
the driver.

A null text, or one without words, has size 0 and is never taken. Null sources form a source of their own. Repeated rows
and null ids are rows of their own. Texts of any length are counted whole. Without any words all targets are 0; an empty table
gives an empty result. Columns other than id, text and source are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from paddock.llm.common import landed, row_key, table

# Fixed value: what counts as a word.
WORD = r"[^\x20\x09-\x0D]+"

TURN = 1 << 31  # points are integers below this
STEP = 2_850_178_704_830_799_621  # the golden ratio's fraction of a turn of 62 bits, odd
CELLS = 1 << 12  # cells of a turn, to look up sources by equality
RUN = 1 << 14  # slots numbered together
BLOCK = 256  # words of a slot


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = "mix") -> DataFrame:
    """key_id, key_hash, source, size, and the place in the shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(*row_key(id_col, text_col), F.col(source_col).alias("source"),
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
                       F.md5(F.concat_ws(":", F.lit(seed), F.col(id_col), F.md5(text))).alias("place"))


def with_targets(rows: DataFrame, total: int, weights: tuple[int, ...], most: int) -> DataFrame:
    """One row per source: source, sid, source_size, target. Its windows hold one row per source."""
    weight: Column = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    per = (rows.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("sid", F.row_number().over(W.orderBy(F.asc_nulls_last("source"))) - 1)
           .withColumns({"w": weight, "limit": (most * F.col("source_size")).cast("double")}))
    order = W.orderBy(F.col("limit") / F.col("w"), "sid")
    before = order.rowsBetween(W.unboundedPreceding, -1)
    left = F.lit(float(total)) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    weigh = F.sum("w").over(order.rowsBetween(W.currentRow, W.unboundedFollowing))
    # full: the share of what the smaller ones leave reaches the limit; these come first in the order
    filled = per.withColumns({"left": left, "weigh": weigh}).withColumn("full", F.col("left") * F.col("w") >= F.col("limit") * F.col("weigh"))
    free = ~F.col("full")
    everyone = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.max(F.when(free, F.col("left"))).over(everyone), F.max(F.when(free, F.col("weigh"))).over(everyone))
    return (filled.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(level[0] * F.col("w") / level[1]))
            .select("source", "sid", "source_size", "target"))


def numbered(df: DataFrame, group: str, piece: Column, order: list[str], amount: Column, name: str) -> DataFrame:
    """``name``: the sum of ``amount`` over the rows of the same group before this one, in the order of (piece, order)."""
    df = df.withColumns({"_piece": piece, "_amount": amount})
    sums = df.groupBy(group, "_piece").agg(F.sum("_amount").alias("_sum"))
    up_to = W.partitionBy(group).orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.withColumn("_before", F.coalesce(F.sum("_sum").over(up_to), F.lit(0))).drop("_sum")
    inside = W.partitionBy(group, "_piece").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (df.withColumn("_inside", F.coalesce(F.sum("_amount").over(inside), F.lit(0))).join(sums, [group, "_piece"])
            .withColumn(name, F.col("_before") + F.col("_inside")).drop("_piece", "_amount", "_before", "_inside"))


def point() -> Column:
    """The point of ``slot``: the upper 31 bits of slot * STEP modulo 2**62."""
    high, low = STEP // TURN, STEP % TURN
    slot = F.col("slot") % TURN
    return (slot * high + F.shiftright(slot * low, 31)) % TURN


def needs(sources: DataFrame, block: int) -> DataFrame:
    """Of each source that takes anything: sid, blocks of its stream, whole rounds, words of the last round, slots."""
    return (sources.withColumn("words", F.floor("target").cast("long")).where("words > 0")
            .select("sid", "source_size", F.ceil(F.col("source_size") / block).cast("long").alias("blocks"),
                    F.floor(F.col("words") / F.col("source_size")).cast("long").alias("whole"), (F.col("words") % F.col("source_size")).alias("rest"))
            .withColumn("needed", F.col("whole") * F.col("blocks") + F.ceil(F.col("rest") / block)))


def schedule(spark: SparkSession, sources: DataFrame, total: int, block: int = BLOCK) -> DataFrame:
    """The mix, slot by slot: slot, sid, rank, round, block, words. Slots from the number of points on settle what the
    points left; they come last, by sid and rank."""
    upto = F.sum(F.floor("target").cast("long")).over(W.orderBy("sid"))
    end = F.floor(F.col("upto").cast("double") / F.lit(float(max(1, total))) * F.lit(float(TURN))).cast("long")
    stretches = (sources.withColumn("upto", upto).withColumn("hi", end)
                 .withColumn("lo", F.coalesce(F.lag("hi").over(W.orderBy("sid")), F.lit(0))).where("lo < hi")
                 .select("sid", "lo", "hi", F.explode(F.sequence(F.floor(F.col("lo") / (TURN // CELLS)), F.floor((F.col("hi") - 1) / (TURN // CELLS)))).alias("cell")))
    n = -(-total // block)
    slots = (spark.range(n).withColumnRenamed("id", "slot").withColumn("point", point())
             .withColumn("cell", F.floor(F.col("point") / (TURN // CELLS))))
    placed = slots.join(stretches, "cell").where("point >= lo AND point < hi").select("slot", "sid")
    ranked = landed(numbered(placed, "sid", F.floor(F.col("slot") / RUN), ["slot"], F.lit(1), "rank"), "ranked")
    needed = landed(needs(sources, block), "needed")
    given = ranked.groupBy("sid").agg(F.count("*").alias("given"))
    settling = (needed.select("sid", "needed").join(given, "sid", "left").withColumn("given", F.coalesce("given", F.lit(0))).where("given < needed")
                .select(F.lit(n).cast("long").alias("slot"), "sid", F.explode(F.sequence(F.col("given"), F.col("needed") - 1)).alias("rank")))
    left = F.when(F.col("round") == F.col("whole"), F.col("rest")).otherwise(F.col("source_size")) - F.col("block") * block
    return (ranked.select("slot", "sid", "rank").unionByName(settling).join(needed, "sid").where("rank < needed")
            .withColumn("round", F.floor(F.col("rank") / F.col("blocks"))).withColumn("block", F.col("rank") % F.col("blocks"))
            .select("slot", "sid", "rank", "round", "block", F.least(F.lit(block), left).alias("words")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix", block: int = BLOCK) -> DataFrame:
    """key_id (the id), key_hash (of the text), source, size, source_size, target, taken: a row for each row of ``docs``."""
    spark = docs.sparkSession
    rows = landed(sized(docs, id_col, text_col, source_col, seed), "sized")
    total = rows.agg(F.sum("size")).first()[0] or 0
    sources = landed(with_targets(rows, total, weights, most), "sources")
    uses = schedule(spark, sources, total, block).groupBy("sid", "block", "words").agg(F.count("*").alias("uses"))
    entries = rows.groupBy(*rows.columns, F.spark_partition_id().alias("lot")).agg(F.count("*").alias("copies"))
    known = entries.join(sources.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    streams = numbered(known, "sid", F.substring("place", 1, 3), ["place", "key_id", "key_hash", "lot"], F.col("size") * F.col("copies"), "first")
    out = ["key_id", "key_hash", "source", "size", "source_size", "target"]
    each = (streams.select("sid", "first", "copies", *out).repartition("sid", "first", "copies")
            .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .withColumn("start", F.col("first") + F.col("copy") * F.col("size")).drop("first", "copies", "copy"))
    end = F.col("start") + F.col("size")
    parts = each.where("size > 0").withColumn("block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    at = F.col("block") * block
    inside = F.greatest(F.lit(0), F.least(end, at + F.col("words")) - F.greatest(F.col("start"), at))
    taken = (parts.join(uses, ["sid", "block"], "left").groupBy("sid", "start", *out)
             .agg(F.coalesce(F.sum(inside * F.col("uses")), F.lit(0)).alias("taken")))
    return taken.select(*out, "taken").unionByName(each.where("size = 0").select(*out, F.lit(0).cast("long").alias("taken")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select(F.col("key_id").alias("doc_id"), "size", "source_size", "target", "taken")


# What a source's stream, in the same shuffle, gives to its target: whole rounds, and the beginning of one more.
ORACLE = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5('mix:' || coalesce(CAST(doc_id AS VARCHAR) || ':', '') || md5(coalesce(text, ''))) AS place FROM documents),
t AS (SELECT CAST(sum(size) AS BIGINT) AS total FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
v AS (SELECT *, CAST([5, 2, 1][sid % 3 + 1] AS DOUBLE) AS w, CAST(3 * source_size AS DOUBLE) AS cap FROM s),
f AS (SELECT v.*, total - coalesce(sum(cap) OVER (ORDER BY cap / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
        sum(w) OVER (ORDER BY cap / w, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weigh FROM v, t),
g AS (SELECT *, CASE WHEN rest * w >= cap * weigh THEN cap
        ELSE max(CASE WHEN rest * w < cap * weigh THEN rest END) OVER () * w / max(CASE WHEN rest * w < cap * weigh THEN weigh END) OVER () END AS target FROM f),
p AS (SELECT d.*, sid, source_size, target, CAST(floor(target) AS BIGINT) AS words,
        CAST(sum(size) OVER (PARTITION BY sid ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS start
        FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
    CAST(CASE WHEN size = 0 THEN 0 ELSE words // source_size * size + least(size, greatest(0, words % source_size - start)) END AS BIGINT) AS taken FROM p
"""
