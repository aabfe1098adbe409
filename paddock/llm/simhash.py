"""Near-duplicate documents by SimHash fingerprints, with pivot distance tables for the search.

1. A document's words, A-Z in lower case, make ``shingle``-word shingles, repeats included (fewer words: the whole
   sequence). A fingerprint bit is set where it is set in over half of the shingles' XXH64 (seed 42); no words: zero.
   Documents with one fingerprint, whatever their number, are one node from here on.
2. Two fingerprints within ``distance`` bits agree in at least two of ``distance`` + 2 blocks of bits, so that every link
   shares one of the 15 buckets that two blocks name (distance 4).
3. The pivot table holds the Hamming distances d(x, p) to ``PIVOTS`` fixed reference fingerprints. By the triangle
   inequality linked x and y have |d(x, p) - d(y, p)| <= ``distance`` for every pivot. A bucket of over ``LARGE`` nodes is
   cut by its next pivot into cells of ``CELL`` distances; a node goes into its own cell and, if within ``distance`` below
   the next, into that too, so that every link still shares a cell. Cells still large are cut by further pivots.
4. In every bucket each node is verified against two hubs, the least and the largest node, and the links so far
   make components. Then pairs of different components that share a bucket are discarded by their largest
   coordinate difference, and the survivors verified on the fingerprints. A large group that is linked already is
   therefore never expanded into pairs, and no link between components is lost: the search is exact.

Output: fingerprint (16 hex digits), component_id (smallest id reachable by links). A null id is larger than any other; where a
whole component has null ids its component_id is null. Null and empty texts have no words. Repeated rows have one
fingerprint and one component. Texts of any length are taken whole, a slice of shingles at a time. An empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import landed, table
from paddock.llm.components import components

SEED = 42  # of XXH64
SLICE = 1 << 15  # shingles hashed at once
PIVOTS, CELL, LARGE = 16, 10, 256

_REFERENCES = [int(x) for x in np.random.default_rng(64).integers(-(1 << 63), (1 << 63) - 1, PIVOTS, dtype=np.int64)]


def fingerprint(text: bytes, shingle: int) -> int:
    words = text.lower().split()  # of bytes: A-Z only, and the six ASCII white space characters
    if not words:
        return 0
    line, k = b" ".join(words), min(shingle, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    ends = ends[k - 1 :].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), SLICE):
        h = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[at : at + SLICE], ends[at : at + SLICE], strict=True)], dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def _fingerprints(shingle: int):
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint((t.as_py() or "").encode(), shingle) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("key_id"), pa.array(found, pa.int64())], names=["key_id", "fp"])

    return emit


def _masks(blocks: int) -> list[int]:
    """Of all pairs of blocks, the bits of both, as signed 64-bit masks."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    one = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:], strict=False)]
    return [int(np.array(one[i] | one[j], dtype=np.uint64).view(np.int64)) for i in range(blocks) for j in range(i)]


def _apart(a: str | Column, b: str | Column) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.bit_count(a.bitwiseXOR(b))


def _to_pivot(i: int) -> Column:
    return _apart("fp", F.lit(_REFERENCES[i]))


def _buckets(nodes: DataFrame, distance: int, large: int) -> DataFrame:
    """(fp, bucket), landed, with the buckets that hold several nodes; every two nodes within ``distance`` share one."""
    keys = [F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(m))) for i, m in enumerate(_masks(distance + 2))]
    entries = landed(nodes.select("fp", F.explode(F.array(*keys)).alias("bucket")), "entries")
    done = []
    for i in range(PIVOTS + 1):
        sizes = landed(entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
        fits = F.col("n") <= large if i < PIVOTS else F.lit(True)
        done.append(entries.join(sizes.where(fits).select("bucket"), "bucket", "left_semi"))
        rest = sizes.where(~fits)
        if rest.isEmpty():
            break
        cells = F.array_distinct(F.array(*[F.floor((_to_pivot(i) + near) / CELL) for near in (0, distance)]))
        cut = (entries.join(rest.select("bucket"), "bucket", "left_semi").select("fp", "bucket", F.explode(cells).alias("cell"))
               .select("fp", F.xxhash64("bucket", F.lit(i), "cell").alias("bucket")))
        entries = landed(cut, "entries")
    return landed(reduce(DataFrame.unionByName, done).distinct(), "buckets")


def links(nodes: DataFrame, distance: int = 4, large: int = LARGE) -> DataFrame:
    """Links (a, b) among different fingerprints ``fp``, enough of them that their components are those of all links."""
    members = _buckets(nodes, distance, large)
    hubs = members.groupBy("bucket").agg(F.min("fp").alias("least"), F.max("fp").alias("most"))
    stars = (members.join(hubs, "bucket").select(F.col("fp").alias("a"), F.explode(F.array("least", "most")).alias("b"))
             .where((F.col("a") != F.col("b")) & (_apart("a", "b") <= distance)))
    stars = landed(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "stars")
    roots = components(stars)

    placed = landed(members.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "bucket", F.coalesce("root", "fp").alias("root")), "placed")
    mixed = landed(placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("bucket"), "mixed")
    side = landed(placed.join(mixed, "bucket", "left_semi").select("*", *[_to_pivot(i).cast("tinyint").alias(f"d{i}") for i in range(PIVOTS)]), "side")
    x, y = side.alias("x"), side.alias("y")
    widest = F.greatest(*[F.abs(F.col(f"x.d{i}") - F.col(f"y.d{i}")) for i in range(PIVOTS)])
    late = (x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.fp") < F.col("y.fp")) & (F.col("x.root") != F.col("y.root"))
                   & (widest <= distance) & (_apart("x.fp", "y.fp") <= distance))
            .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b")))
    return landed(stars.unionByName(late.distinct()), "links")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, distance: int = 4,
                    large: int = LARGE) -> DataFrame:
    """key_id (the id), fingerprint, component_id: a row for each row of ``docs``."""
    texts = docs.select(F.col(id_col).alias("key_id"), F.col(text_col).alias("text"))
    found = landed(texts.mapInArrow(_fingerprints(shingle), f"key_id {docs.schema[id_col].dataType.simpleString()}, fp long"), "fingerprints")
    nodes = landed(found.groupBy("fp").agg(F.min("key_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fp"), distance, large)).withColumnRenamed("node", "fp")
    placed = landed(nodes.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    # written, so that the joins back may split a large component or a large group of copies
    ids = landed(placed.groupBy("root").agg(F.min("least").alias("component_id")), "components")
    labels = landed(placed.join(ids, "root").select("fp", "component_id"), "labels")
    return found.join(labels, "fp").select("key_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("key_id", "doc_id")
