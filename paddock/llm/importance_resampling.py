"""Importance resampling towards a target distribution of hashed word n-grams, with the texts cut into segments.

A line break separates words, so a text's n-grams are those of its lines and those that cross lines.

1. Lines, over all documents, are grouped with their number of occurrences. The features (runs of 1 to 2 words, as buckets of
   their CRC-32) of each different line are computed once, and count as often as the line occurs.
2. Per document: the MD5s of its lines with words, with their multiplicities, and the buckets of the n-grams
   that cross lines. No text leaves the task that reads it.
3. Counts per bucket, over lines and crossings, are summed per task and then by bucket. The same gives the target's. From
   both come the gains: one whole number per bucket, the only data that goes to every task (``BUCKETS`` of them).
4. Each different line's gain is summed once; a document's total is that of its lines by a join on the MD5, times their
   multiplicities, and of its crossings. Its weight is the floored mean; the score adds Gumbel noise from its id.
5. The highest scores are drawn. Places are numbered in two levels: rows are counted per score (thousandths of a logarithm, so
   their number is bounded by the range of a double's logarithm, whatever the input), running sums over the
   scores give the places before each, and a window numbers the ids of one score; the noise spreads any
   weight over some ten thousand scores.

Defined cases: null and empty texts have no words, weight 0 and no place; a null id is hashed as an empty one and comes last on
ties. Rows that repeat id and text are counted as documents and get neighbouring places. Lines of any length are
taken whole. An empty target or table is all zeros: every count has one added. Columns other than id and text pass by.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.llm.common import SQL_CRC_TABLE, landed, row_key, sql_crc32, table
from paddock.llm.wordhash import FOLD, byte_class

# Fixed value: what makes words.
_IS_WORD = byte_class([(0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)])

BUCKETS = 10_000
SLICE = 1 << 20  # bytes of text hashed at once
LONG = 64  # bytes of a word hashed by itself
_NEWLINE = 0x0A


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _crc_table()


def _advance(state: np.ndarray, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 registers after reading each word's bytes."""
    state = state.copy()
    active = np.flatnonzero(sizes <= LONG)
    for j in range(int(sizes[active].max(initial=0))):
        active = active[sizes[active] > j]
        old = state[active]
        state[active] = _CRC[(old ^ data[starts[active] + j]) & 255] ^ (old >> 8)
    for i in np.flatnonzero(sizes > LONG).tolist():
        state[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]].tobytes(), int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    return state


class Words:
    """The words of a buffer, A-Z in lower case, and their registers."""

    def __init__(self, raw: bytes):
        self.data = FOLD[np.frombuffer(raw, dtype=np.uint8)]
        edges = np.flatnonzero(np.diff(np.concatenate(([False], _IS_WORD[self.data], [False])).view(np.int8)))
        self.starts, self.sizes = edges[::2], edges[1::2] - edges[::2]

    def registers(self, which: np.ndarray) -> np.ndarray:
        return _advance(np.full(len(which), 0xFFFFFFFF, dtype=np.uint32), self.data, self.starts[which], self.sizes[which])

    def joined(self, state: np.ndarray, following: np.ndarray) -> np.ndarray:
        """Registers after one space and the words ``following``."""
        state = _CRC[(state ^ 0x20) & 255] ^ (state >> 8)
        return _advance(state, self.data, self.starts[following], self.sizes[following])

    @staticmethod
    def buckets(state: np.ndarray) -> np.ndarray:
        return ((state ^ 0xFFFFFFFF) % BUCKETS).astype(np.uint16)


def line_features(lines: list[bytes]) -> list[np.ndarray]:
    """The buckets of each line's words and pairs of neighbouring words."""
    words = Words(b"\n".join(lines))
    of = np.searchsorted(np.cumsum([len(x) + 1 for x in lines]), words.starts, side="right")
    state = words.registers(np.arange(len(words.starts)))
    first = np.flatnonzero(of[1:] == of[:-1])
    found = np.concatenate((words.buckets(state), words.buckets(words.joined(state[first], first + 1))))
    of = np.concatenate((of, of[first]))
    order = np.argsort(of, kind="stable")
    return np.split(found[order], np.searchsorted(of[order], np.arange(1, len(lines))))


def document_parts(raw: bytes) -> tuple[int, dict[bytes, int], np.ndarray]:
    """Number of words, lines with words and how often they occur, and the buckets of pairs that cross lines."""
    words = Words(raw)
    breaks = np.flatnonzero(words.data == _NEWLINE)
    of = np.searchsorted(breaks, words.starts)
    first = np.flatnonzero(of[1:] != of[:-1])
    lines: dict[bytes, int] = {}
    edges = np.concatenate(([-1], breaks, [len(raw)]))
    for i in np.unique(of).tolist():
        line = raw[edges[i] + 1 : edges[i + 1]]
        lines[line] = lines.get(line, 0) + 1
    return len(words.starts), lines, words.buckets(words.joined(words.registers(first), first + 1))


def _slices(values: list[bytes]) -> Iterator[tuple[int, int]]:
    at, size = 0, 0
    for i, v in enumerate(values):
        size += len(v) + 1
        if size >= SLICE:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(values):
        yield at, len(values)


LINES = pa.schema([("digest", pa.binary()), ("times", pa.int64()), ("buckets", pa.binary())])


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines = [x.as_py().encode() for x in batch.column("line")]
        for a, b in _slices(lines):
            found = [x.tobytes() for x in line_features(lines[a:b])]
            digests = [hashlib.md5(x).digest() for x in lines[a:b]]
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), batch.column("times").slice(a, b - a), pa.array(found, pa.binary())], schema=LINES)


DOCS = "key_id {id}, key_hash bigint, n_words bigint, lines array<struct<digest:binary,times:bigint>>, buckets binary"


def _doc_rows(schema: pa.Schema):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [document_parts((t.as_py() or "").encode()) for t in batch.column("text")]
            lists = [[{"digest": hashlib.md5(k).digest(), "times": n} for k, n in p[1].items()] for p in parts]
            columns = [batch.column("key_id"), batch.column("key_hash"), [p[0] for p in parts], lists, [p[2].tobytes() for p in parts]]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return emit


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ``times`` and ``buckets`` to the task's count of each bucket."""
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        raw = batch.column("buckets").to_pylist()
        n = np.array([len(x) // 2 for x in raw], dtype=np.int64)
        weights = np.repeat(batch.column("times").to_numpy(zero_copy_only=False).astype(np.int64), n)
        np.add.at(total, np.frombuffer(b"".join(raw), dtype=np.uint16), weights)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some])], names=["bucket", "n"])


def _gained(gains: np.ndarray, keep: list[str]):
    """``keep`` and the sum of the gains of ``buckets``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("buckets").to_pylist()
            sums = np.concatenate(([0], np.cumsum(gains[np.frombuffer(b"".join(raw), dtype=np.uint16)])))
            ends = np.cumsum([0, *[len(x) // 2 for x in raw]])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())], names=[*keep, "gain"])

    return emit


def segmented(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Different lines (digest, times, buckets), and different documents (key, times, n_words, lines, buckets that cross lines), landed."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    texts = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''").groupBy("line").agg(F.count("*").alias("times"))
    lines = landed(lines.mapInArrow(_line_rows, "digest binary, times bigint, buckets binary"), "lines", compression="zstd")
    ddl = DOCS.format(id=docs.schema[id_col].dataType.simpleString())
    parts = landed(texts.mapInArrow(_doc_rows(to_arrow_schema(StructType.fromDDL(ddl))), ddl), "documents", compression="zstd")
    once = parts.groupBy("key_id", "key_hash").agg(F.count("*").alias("times"), *[F.first(c).alias(c) for c in ("n_words", "lines", "buckets")])
    return lines, landed(once, "once", compression="zstd")


def bucket_counts(lines: DataFrame, parts: DataFrame) -> np.ndarray:
    rows = lines.select("times", "buckets").unionByName(parts.select("times", "buckets"))
    out = np.zeros(BUCKETS, dtype=np.int64)
    for r in rows.mapInArrow(_counted, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows
        out[r.bucket] = r.n
    return out


def gains_of(s: np.ndarray, t: np.ndarray) -> np.ndarray:
    whole_s, whole_t = float(s.sum()) + BUCKETS, float(t.sum()) + BUCKETS
    return np.array([math.floor(1000 * math.log((b + 1.0) * whole_s / ((a + 1.0) * whole_t))) for a, b in zip(s.tolist(), t.tolist(), strict=True)], dtype=np.int64)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text",
             percent: int = 25, min_words: int = 20, seed: int = 7) -> DataFrame:
    """key_id (the id), key_hash (of the text), n_features, weight, score, rank (null: not drawn): a row for each row of ``docs``."""
    lines, parts = segmented(docs, id_col, text_col)
    wanted = target.select(F.lit(0).alias("id"), F.col(target_text).alias("text"))
    gains = gains_of(bucket_counts(lines, parts), bucket_counts(*segmented(wanted, "id", "text")))

    names = ["key_id", "key_hash", "times", "n_words"]
    line_gains = lines.mapInArrow(_gained(gains, ["digest"]), "digest binary, gain bigint")
    ddl = ", ".join(f"{c} {parts.schema[c].dataType.simpleString()}" for c in names) + ", gain bigint"
    crossing = parts.mapInArrow(_gained(gains, names), ddl)
    # the pairs of a line in many documents may be split by the join
    pairs = parts.select(*names, F.explode("lines").alias("l")).select(*names, "l.digest", F.col("l.times").alias("again"))
    of_lines = pairs.join(landed(line_gains, "line-gains"), "digest").select(*names, (F.col("gain") * F.col("again")).alias("gain"))
    total = crossing.unionByName(of_lines).groupBy(*names).agg(F.sum("gain").alias("gain"))

    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    scored = (total.withColumn("n_features", F.greatest(2 * F.col("n_words") - 1, F.lit(0)).cast("long"))
              .withColumn("weight", F.when(F.col("n_words") > 0, F.expr("(gain - pmod(gain, n_features)) div n_features")).otherwise(0).cast("long"))
              .withColumn("score", (F.col("weight") + noise).cast("long")))
    scored = landed(scored.select("key_id", "key_hash", "times", "n_features", "weight", "score", (F.col("n_words") >= min_words).alias("enough")), "scored")

    per_score = landed(scored.where("enough").groupBy("score").agg(F.sum("times").alias("n")), "scores")
    drawn = percent * (per_score.agg(F.sum("n").alias("n")).first().n or 0) // 100
    before = F.coalesce(F.sum("n").over(Window.orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = per_score.select("score", before.alias("before")).where(F.col("before") < drawn)
    ids = Window.partitionBy("score").orderBy(F.col("key_id").asc_nulls_last(), "key_hash").rowsBetween(Window.unboundedPreceding, -1)
    near = scored.where("enough").join(before, "score").withColumn("place", F.col("before") + F.coalesce(F.sum("times").over(ids), F.lit(0))).drop("before")
    rest = scored.join(before, scored["enough"] & (scored["score"] == before["score"]), "left_anti").withColumn("place", F.lit(None).cast("long"))
    each = near.unionByName(rest).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    rank = F.col("place") + F.col("copy")
    return each.select("key_id", "key_hash", "n_features", "weight", "score", F.when(rank <= drawn, rank).alias("rank"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("key_hash").withColumnRenamed("key_id", "doc_id")


_FEATURES = r"""SELECT {id} AS id, w, list_concat(w, list_transform(range(len(w) - 1), lambda i: w[i + 1] || ' ' || w[i + 2])) AS f
    FROM (SELECT {id}, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM {table})"""

ORACLE = rf"""
WITH crc AS (SELECT {SQL_CRC_TABLE} AS t),
d AS ({_FEATURES.format(id="doc_id", table="documents")}),
b AS ({_FEATURES.format(id="item_id", table="benchmark")}),
e AS (SELECT id, unnest(f) AS x FROM d),
u AS (SELECT unnest(f) AS x FROM b),
bucket AS (SELECT x, {sql_crc32("x")} % 10000 AS k FROM (SELECT x FROM e UNION SELECT x FROM u), crc),
s AS (SELECT k, count(*) AS s FROM e JOIN bucket USING (x) GROUP BY k),
t AS (SELECT k, count(*) AS t FROM u JOIN bucket USING (x) GROUP BY k),
whole AS (SELECT (SELECT count(*) FROM e) AS s_all, (SELECT count(*) FROM u) AS t_all),
gain AS (SELECT s.k, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) AS DOUBLE) * (s_all + 10000) / (CAST(s + 1 AS DOUBLE) * (t_all + 10000)))) AS BIGINT) AS g
    FROM s LEFT JOIN t USING (k), whole),
weight AS (SELECT id, sum(g) AS g FROM e JOIN bucket USING (x) JOIN gain USING (k) GROUP BY id),
score AS (SELECT d.id AS doc_id, CAST(len(f) AS BIGINT) AS n_features, CAST(coalesce(floor(CAST(g AS DOUBLE) / len(f)), 0) AS BIGINT) AS weight, len(w) >= 20 AS enough,
    CAST(floor(-1000 * ln(-ln((CAST('0x' || left(sha256('7:' || coalesce(CAST(d.id AS VARCHAR), '')), 8) AS BIGINT) + 0.5) / 4294967296))) AS BIGINT) AS noise
    FROM d LEFT JOIN weight ON weight.id = d.id),
placed AS (SELECT doc_id, n_features, weight, weight + noise AS score, enough,
    row_number() OVER (PARTITION BY enough ORDER BY weight + noise DESC, doc_id NULLS LAST) AS place FROM score)
SELECT doc_id, n_features, weight, score,
    CASE WHEN enough AND place <= (SELECT 25 * count(*) // 100 FROM score WHERE enough) THEN place END AS rank FROM placed
"""
