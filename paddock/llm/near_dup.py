"""Near-duplicate documents by SetSketch registers, banded, estimated jointly by likelihood, and verified.

1. A document's set is its different ``shingle``-word shingles (fewer words: the whole sequence), as 64-bit hashes.
   Documents with equal sets, whatever their number, are one node (a 64-bit digest of the set) from here on.
2. A SetSketch has ``REGISTERS`` registers. Register i is the least of the exponentially distributed values that
   hash function i gives the set's shingles, truncated to whole powers of ``BASE``: floor(1 - log_b(min)), within
   0 and ``TOP``. The register-wise maximum of two sketches is the sketch of the union, and with a base near 1
   two registers agree with a probability just above the Jaccard similarity.
3. Bands of ``ROWS`` registers are bucket keys. With 25 bands of 5, a pair at similarity 0.85 shares no bucket with
   probability 5e-7, and a less similar pair shares some more rarely.
4. In each bucket every node is paired with two hubs, the smallest node and the smallest by hash, so that a
   bucket of any size gives a number of pairs in proportion. A joint likelihood of all registers, with both set sizes
   known, drops pairs that are practically below the threshold; the rest is verified on the full sets.
5. Components of the links so far are found. Only nodes of different components that share a bucket still matter.
   These are compared with each other, once per pair, if their sets can reach the threshold at all: of each of
   ``PARTS`` parts of the shingles, no more can be common than either set has that some other open node has too.
   The sum over the parts is close to the true number, as edits of two copies seldom fall into the same part. So
   no link is lost that shares a bucket, and neither a large group of copies, linked already, nor a large
   group of texts that are not quite similar enough is expanded into pairs.

Output: n_shingles (set size), component_id (smallest id reachable by links), kept (id = component_id). Documents without
words or text have an empty set and no links. A null id is larger than any other; where a whole component has null ids, its
component_id is null and all are kept. Rows that repeat id and text are one document: equal sets, all kept or none.
An empty table gives an empty result. Texts of any length are taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import join_by_key, landed, row_key, table
from paddock.llm.components import components
from paddock.llm.wordhash import FOLD, SLICE, byte_class, hashed_words, mixed

# Fixed value: what separates words.
_IS_WORD = ~byte_class([(0x09, 0x0E), (0x20, 0x21)])

BANDS, ROWS = 25, 5
PARTS = 64
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2

_RNG = np.random.default_rng(77)
_FLIPS = _RNG.integers(0, 1 << 64, REGISTERS, dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RNG.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TURNS = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The sorted different shingle hashes of each text."""
    data = FOLD[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
    starts, _, words = hashed_words(data, _IS_WORD)
    limits = np.cumsum([len(t) + 1 for t in texts])
    last = np.searchsorted(starts, limits - 1).tolist()
    out, first = [], 0
    for end in last:
        w = words[first:end]
        k = min(shingle, len(w))
        n = len(w) - k + 1 if k else 0
        h = np.full(n, len(w) if k < shingle else shingle, dtype=np.uint64)
        for j in range(k):
            h = mixed(h + w[j : j + n] * _TURNS[j % 64])
        out.append(np.unique(h))
        first = end
    return out


def sketch(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes; all 0 for the empty set."""
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), 2048):
        h = hashes[at : at + 2048, None]
        np.minimum(least, ((h ^ _FLIPS) * _ODD).min(axis=0), out=least)
    if not len(hashes):
        return np.zeros(REGISTERS, dtype=np.uint16)
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64 * (1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(value) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A key for each band: equal where all its registers are."""
    parts = mixed((registers.astype(np.uint64) + np.uint64(1)) * _BAND).reshape(BANDS, ROWS).sum(axis=1, dtype=np.uint64)
    return mixed(parts + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def similarity_likelihood(more: np.ndarray, less: np.ndarray, n1: np.ndarray, n2: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Joint log-likelihood of Jaccard similarity ``j`` where of all registers ``more`` are larger in the first
    sketch and ``less`` in the second, of sets of sizes ``n1`` and ``n2``."""
    u = n1 / (n1 + n2)
    common = j / (1 + j)  # of n1 + n2
    p = lambda x: -np.log1p(-np.clip(x, 1e-9, None) * (BASE - 1) / BASE) / np.log(BASE)
    # what only one set has, as a share of the union
    up, down = p((u - common) * (1 + j)), p((1 - u - common) * (1 + j))
    return more * np.log(up) + less * np.log(down) + (REGISTERS - more - less) * np.log(np.clip(1 - up - down, 1e-9, None))


def may_reach(first: pd.Series, second: pd.Series, n1: pd.Series, n2: pd.Series, threshold: float, margin: float) -> pd.Series:
    """False where the likelihood at ``threshold`` is less than that of the best similarity by e**margin."""
    if not len(first):
        return pd.Series([], dtype=bool)
    a = np.frombuffer(b"".join(first), dtype=np.uint16).reshape(-1, REGISTERS)
    b = np.frombuffer(b"".join(second), dtype=np.uint16).reshape(-1, REGISTERS)
    more, less = (a > b).sum(axis=1)[:, None], (a < b).sum(axis=1)[:, None]
    x, y = n1.to_numpy(dtype=float)[:, None], n2.to_numpy(dtype=float)[:, None]
    most = np.minimum(x, y) / np.maximum(x, y)
    grid = most * np.linspace(0.002, 1, 128)
    fit = similarity_likelihood(more, less, x, y, grid)
    at = similarity_likelihood(more, less, x, y, np.minimum(threshold, most))[:, 0]
    best = fit.argmax(axis=1)
    return pd.Series((np.take_along_axis(grid, best[:, None], 1)[:, 0] >= threshold) | (fit.max(axis=1) - at <= margin))


def _sketches(shingle: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, hashes, sets in _sets_of(batches, shingle):
            rows = [(i, h, len(s), *((_node(s), sketch(s).tobytes()) if len(s) else (None, None))) for i, h, s in zip(ids, hashes, sets, strict=True)]
            keys = [band_keys(np.frombuffer(r[4], dtype=np.uint16)) if r[4] else None for r in rows]
            columns = [*map(list, zip(*rows, strict=True)), keys]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                             names=["key_id", "key_hash", "n_shingles", "node", "registers", "bands"])

    return emit


def _full_sets(shingle: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, sets in _sets_of(batches, shingle):
            yield pa.RecordBatch.from_arrays([pa.array([_node(s) for s in sets], pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))],
                                             names=["node", "items"])

    return emit


def _sets_of(batches: Iterator[pa.RecordBatch], shingle: int):
    for whole in batches:
        sizes = np.cumsum([len(t.as_py() or "") for t in whole.column("text")])
        at = 0
        while at < whole.num_rows:  # about a slice of text at once
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE)))
            batch = whole.slice(at, end - at)
            texts = [(t.as_py() or "").encode() for t in batch.column("text")]
            yield batch.column("key_id").to_pylist(), batch.column("key_hash").to_pylist(), shingle_sets(texts, shingle)
            at = end


def _node(hashes: np.ndarray) -> int:
    """A digest of a whole set."""
    with np.errstate(over="ignore"):
        x = np.array([mixed(hashes).sum(dtype=np.uint64), (mixed(hashes ^ _FLIPS[0]) * _ODD[0]).sum(dtype=np.uint64)])
        return int(mixed(x[:1] * _ODD[1] + mixed(x[1:]) + np.uint64(len(hashes))).view(np.int64)[0])


def _similar(common: Column, n1: Column, n2: Column, percent: int) -> Column:
    return 100 * common >= percent * (n1 + n2 - common)


def _verified(pairs: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, margin: float) -> DataFrame:
    """The links (a, b) among candidate pairs: likelihood first, then the full sets."""
    known = nodes.select("node", "registers", "n_shingles")
    pairs = (pairs.join(known.toDF("a", "r1", "n1"), "a").join(known.toDF("b", "r2", "n2"), "b"))
    threshold = percent / 100

    @F.pandas_udf("boolean")
    def likely(r1: pd.Series, r2: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
        return may_reach(r1, r2, n1, n2, threshold, margin)

    pairs = landed(pairs.where(likely("r1", "r2", "n1", "n2")).select("a", "b", "n1", "n2"), "likely")
    common = F.size(F.array_intersect("s1", "s2"))
    return (pairs.join(sets.toDF("a", "s1"), "a").join(sets.toDF("b", "s2"), "b")
            .where(_similar(common, F.col("n1"), F.col("n2"), percent)).select("a", "b"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, margin: float = 12.0) -> DataFrame:
    """key_id (the id), key_hash (of the text), n_shingles, component_id, kept: a row for each row of ``docs``."""
    texts = docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text"))
    found = landed(texts.mapInArrow(_sketches(shingle), "key_id long, key_hash long, n_shingles long, node long, registers binary, bands array<long>"), "sketches")

    entries = found.where("node is not null").select("node", F.explode("bands").alias("bucket")).distinct()
    entries = landed(entries, "entries")
    shared = landed(entries.groupBy("bucket").agg(F.count("*").alias("c"), F.min("node").alias("h1"),
                                                  F.min_by("node", F.xxhash64("node", "bucket")).alias("h2")).where("c > 1").drop("c"), "shared")
    members = landed(entries.join(shared, "bucket"), "members")
    inside = landed(members.select("node").distinct(), "inside")
    rows = found.where("node is not null").join(inside, "node", "left_semi")
    nodes = landed(rows.groupBy("node").agg(*(F.first(c).alias(c) for c in ("registers", "n_shingles", "bands"))), "nodes")
    one = rows.groupBy("node").agg(F.min(F.struct("key_id", "key_hash")).alias("k")).select("k.*", "node")
    sets = landed(join_by_key(texts, one.dropDuplicates(["key_id", "key_hash"]), "inner").dropDuplicates(["key_id", "key_hash"])
                  .select("key_id", "key_hash", "text").mapInArrow(_full_sets(shingle), "node long, items array<long>"), "sets")

    def pairs_of(df: DataFrame) -> DataFrame:
        return landed(df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct(), "pairs")

    stars = pairs_of(members.select(F.col("node").alias("a"), F.explode(F.array("h1", "h2")).alias("b")))
    links = landed(_verified(stars, nodes, sets, percent, margin), "verified")
    roots = components(links)

    placed = landed(members.select("bucket", "node").join(roots, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("root")), "placed")
    mixed_buckets = landed(placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("bucket"), "mixed")
    open_ = landed(placed.join(mixed_buckets, "bucket", "left_semi"), "open")
    open_nodes = landed(open_.select("node").distinct(), "open-nodes")
    items = landed(sets.join(open_nodes, "node", "left_semi").select("node", F.explode("items").alias("item")), "items")
    again = landed(items.groupBy("item").agg(F.count("*").alias("c")).where("c > 1").select("item"), "again")
    parts = (items.join(again, "item", "left_semi").groupBy("node", F.pmod("item", F.lit(PARTS)).cast("int").alias("part"))
             .agg(F.count("*").cast("int").alias("n")).groupBy("node")
             .agg(F.sum("n").alias("most"), F.map_from_entries(F.collect_list(F.struct("part", "n"))).alias("by"))
             .select("node", "most", F.transform(F.sequence(F.lit(0), F.lit(PARTS - 1)), lambda p: F.coalesce(F.col("by")[p], F.lit(0))).alias("parts")))
    side = landed(open_.join(parts, "node").join(nodes.select("node", "n_shingles", "bands"), "node"), "side")
    x, y = side.alias("x"), side.alias("y")
    bound = F.least("x.most", "y.most")
    close = F.aggregate(F.zip_with("x.parts", "y.parts", lambda p, q: F.least(p, q)), F.lit(0), lambda s, n: s + n)
    before = F.array_position("x.bands", F.col("x.bucket")) - 1  # bands before this one; their keys differ
    earlier = F.exists(F.arrays_zip(F.slice("x.bands", 1, before.cast("int")).alias("p"), F.slice("y.bands", 1, before.cast("int")).alias("q")), lambda z: z["p"] == z["q"])
    crossing = (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.root") != F.col("y.root"))
                       & _similar(bound, F.col("x.n_shingles"), F.col("y.n_shingles"), percent) & ~earlier
                       & _similar(close, F.col("x.n_shingles"), F.col("y.n_shingles"), percent))
                .select(F.col("x.node").alias("a"), F.col("y.node").alias("b")))
    late = landed(_verified(pairs_of(crossing), nodes, sets, percent, margin), "verified")

    roots = components(landed(links.unionByName(late), "all-links")) if not late.isEmpty() else roots
    ids = found.where("node is not null").groupBy("node").agg(F.min("key_id").alias("least"))
    per_node = landed(ids.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"), "least"), "node-roots")
    # written, so that the join back may split the nodes of a large component
    per_root = landed(per_node.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    labels = landed(per_node.join(per_root, "root").select("node", "component_id"), "labels")
    out = found.select("key_id", "key_hash", "n_shingles", "node").join(labels, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("key_id")).otherwise(F.col("component_id"))
    return (out.withColumn("component_id", own).drop("node")
            .withColumn("kept", F.coalesce(F.col("key_id") == F.col("component_id"), F.col("component_id").isNull())))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return out.select(F.col("key_id").alias("doc_id"), "n_shingles", "component_id", "kept")


# The same by brute force over all pairs that share a shingle.
ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM common JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE 100 * c >= 85 * (len(p.s) + len(q.s) - c)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
root AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN root USING (doc_id)
"""
