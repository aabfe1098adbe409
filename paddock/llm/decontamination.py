"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of the benchmark items: every ``window`` consecutive words, or all words of a shorter item.
Patterns of one length form a search of its own. A shift table, indexed by the hash of a block of up to three words,
says how far the search may jump when that block ends the position at hand: a block that no pattern holds skips almost
a whole pattern length. At shift 0 the block's hash selects a bucket of patterns that end with it, their first
block's hash must fit too, and only then the words themselves are compared, so that no hash can make a hit. Texts
are cut into lanes that jump side by side, which keeps the search inside numpy.

The pattern table goes to the executors in blocks of about ``block_patterns`` (pattern, item) pairs and ``block_bytes`` of
text; only a single pattern longer than that travels as it is. A larger benchmark takes several passes over the documents, not
a larger broadcast: each pass writes the row keys, hits and items of documents with a hit (the first the number of words of
all), these are added up by key and joined to the documents. Texts are only read, never written or shuffled for it.

Null or empty texts, and texts without words, have no words and no hits. Items without words have no windows; an item
with a null id counts as one with the empty id, and rows of one id are one item. Repeated documents are judged row by row, an
empty benchmark hits nothing, an empty table gives an empty result. Other columns pass through; input columns
named like an output are replaced.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.common import join_by_key, landed, row_key, table
from paddock.llm.wordhash import FOLD, SLICE, byte_class, hashed_words, mixed

# Fixed value: what counts as a word, after A-Z are lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

LANE = 128  # window positions of a lane
BLOCK_WORDS = 3

_IS_WORD = byte_class([(0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)])

_WEIGHTS = np.random.default_rng(14).integers(1 << 62, 1 << 64, BLOCK_WORDS, dtype=np.uint64) | np.uint64(1)


def block_hash(hashes: np.ndarray, ends: np.ndarray, words: int) -> np.ndarray:
    """Hash of the ``words`` words that end at each place."""
    out = hashes[ends] * _WEIGHTS[0]
    for k in range(1, words):
        out = out + hashes[ends - k] * _WEIGHTS[k]
    return mixed(out)


class WuManber:
    """The shift table and the buckets for patterns of one length in words."""

    def __init__(self, patterns: dict[bytes, set[str]], length: int):
        self.length, self.block = length, min(BLOCK_WORDS, length)
        self.items, self.buckets = patterns, defaultdict(list)
        texts = list(patterns)
        hashes = hashed_words(np.frombuffer(b"\n".join(texts), dtype=np.uint8), _IS_WORD)[2]
        first = np.arange(len(texts)) * length
        bits = max(12, int(4 * len(texts) * length).bit_length())
        self.down = np.uint64(64 - min(bits, 24))
        self.shift = np.full(1 << min(bits, 24), length - self.block + 1, dtype=np.int64)
        for j in range(self.block, length + 1):  # later blocks allow smaller shifts, so they come last
            self.shift[block_hash(hashes, first + j - 1, self.block) >> self.down] = length - j
        heads = block_hash(hashes, first + self.block - 1, self.block)
        tails = block_hash(hashes, first + length - 1, self.block)
        for text, head, tail in zip(texts, heads.tolist(), tails.tolist(), strict=True):
            self.buckets[tail].append((head, text))

    def search(self, folded: np.ndarray, starts, ends, hashes, first, last) -> Iterator[tuple[int, set[str]]]:
        """(last word, items) of each occurrence in texts that hold the words ``first`` to ``last`` (excluded)."""
        room = last - first - self.length + 1
        first, room = first[room > 0], room[room > 0]
        lanes = -(-room // LANE)
        of = np.repeat(np.arange(len(first)), lanes)
        begin = LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
        at = first[of] + begin + self.length - 1
        stop = at + np.minimum(LANE, room[of] - begin)
        while len(at):
            tails = block_hash(hashes, at, self.block)
            shift = self.shift[tails >> self.down]
            for i in np.flatnonzero(shift == 0).tolist():
                if bucket := self.buckets.get(int(tails[i])):
                    yield from self._compared(bucket, folded, starts, ends, hashes, int(at[i]))
            at = at + np.maximum(shift, 1)
            going = at < stop
            at, stop = at[going], stop[going]

    def _compared(self, bucket, folded, starts, ends, hashes, at: int):
        begin = at - self.length + 1
        head = int(block_hash(hashes, np.array([begin + self.block - 1]), self.block)[0])
        text = None
        for expected, pattern in bucket:
            if head == expected:
                text = text or b" ".join(folded[s:e].tobytes() for s, e in zip(starts[begin : at + 1].tolist(), ends[begin : at + 1].tolist(), strict=True))
                if text == pattern:
                    yield at, self.items[pattern]


class Searcher:
    """All lengths of one block of patterns."""

    def __init__(self, pairs: list[tuple[str, int, str]]):
        lengths: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
        for pattern, length, item in pairs:
            lengths[length][pattern.encode()].add(item)
        self.searches = [WuManber(dict(p), n) for n, p in sorted(lengths.items())]

    def matches(self, texts: list[bytes]) -> list[tuple[int, list[tuple[int, int]], set[str]]]:
        """For each text: its number of words, the maximal runs of hit words (first, number), and the items that hit."""
        folded = FOLD[np.frombuffer(b"\n".join(texts), dtype=np.uint8)]
        starts, ends, hashes = hashed_words(folded, _IS_WORD)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        limits = np.cumsum(sizes + 1)
        last = np.searchsorted(starts, limits - 1)
        first = np.concatenate(([0], last[:-1]))
        hit: dict[int, tuple[list, set]] = defaultdict(lambda: ([], set()))
        for search in self.searches:
            for at, items in search.search(folded, starts, ends, hashes, first, last):
                windows, found = hit[int(np.searchsorted(last, at, side="right"))]
                windows.append((at - search.length + 1, at + 1))
                found |= items
        out = []
        for i, (a, b) in enumerate(zip(first.tolist(), last.tolist(), strict=True)):
            runs: list[tuple[int, int]] = []
            if i in hit:
                for s, e in sorted(hit[i][0]):
                    if runs and s <= runs[-1][1]:
                        runs[-1] = (runs[-1][0], max(runs[-1][1], e))
                    else:
                        runs.append((s, e))
            out.append((b - a, [(s - a, e - s) for s, e in runs], hit[i][1] if i in hit else set()))
        return out


RUNS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("words", T.LongType())]))
ADDED = [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("items", T.ArrayType(T.StringType()))]

_workers: dict[str, Searcher] = {}


def _searcher(shared: Broadcast, name: str) -> Searcher:
    if name not in _workers:
        _workers.clear()
        _workers[name] = Searcher(shared.value)
    return _workers[name]


def patterns(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = 13) -> DataFrame:
    """One row per different (pattern, words, item)."""
    words = F.regexp_extract_all(F.translate(text_col, UPPER, LOWER), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), words.alias("w")).where(F.size("w") > 0)
    return items.select(
        "item", F.least(F.size("w"), F.lit(window)).alias("words"),
        F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1))),
                              lambda i: F.array_join(F.slice("w", i, window), " "))).alias("pattern")).distinct()


def _scan(shared: Broadcast, name: str, text_col: str, schema: pa.Schema, hits_only: bool):
    """The columns of ``schema``: those of the rows that it names, and what the search finds."""
    added = [f.name for f in ADDED]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = _searcher(shared, name)
        for whole in batches:
            sizes = np.cumsum([len(t.as_py() or "") for t in whole.column(text_col)])
            at = 0
            while at < whole.num_rows:  # about a slice of text at once
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE)))
                batch = whole.slice(at, end - at)
                found = searcher.matches([(t.as_py() or "").encode() for t in batch.column(text_col)])
                n_words, runs, items = (list(x) for x in zip(*found, strict=True))
                runs = [[{"first": f, "words": n} for f, n in r] for r in runs]
                kept = [batch.column(f.name) for f in schema if f.name not in added]
                out = pa.RecordBatch.from_arrays([*kept, pa.array(n_words, pa.int64()), pa.array(runs, schema.field("runs").type),
                                                  pa.array([sorted(x) for x in items], pa.list_(pa.string()))], schema=schema)
                yield out.filter(pa.array([bool(r) for r in runs])) if hits_only else out
                at = end

    return scan


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", window: int = 13, percent: int = 5,
                       block_patterns: int = 200_000, block_bytes: int = 1 << 26, id_col: str = "doc_id") -> DataFrame:
    """``docs`` with n_words, runs (hit words: first, words; may overlap after several passes), items (ids as sorted
    strings), n_hit and contaminated (n_hit > 0 and at least ``percent`` of the words)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    spark = docs.sparkSession
    table_ = landed(patterns(benchmark, item_col, item_text_col, window), "patterns")
    size = table_.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("pattern") + F.octet_length("item")), F.lit(0)).alias("bytes")).first()
    blocks = max(1, -(-size.n // block_patterns), -(-size.bytes // block_bytes))
    out = docs.drop(*(f.name for f in ADDED), "n_hit", "contaminated")

    def searched(df: DataFrame, columns: list[T.StructField], block: int) -> DataFrame:
        part = table_.where(F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks)) == block) if blocks > 1 else table_
        shared = spark.sparkContext.broadcast([(r.pattern, r.words, r.item) for r in part.collect()])
        schema = T.StructType([*columns, *ADDED])
        return df.mapInArrow(_scan(shared, uuid.uuid4().hex, text_col, to_arrow_schema(schema), block > 0), schema)

    if blocks == 1:
        out = searched(out, out.schema.fields, 0)
        merged = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + r["words"])
    else:
        texts = out.select(*row_key(id_col, text_col), text_col)
        key = [texts.schema["key_id"], texts.schema["key_hash"]]
        passes = [landed(searched(texts, key, b).dropDuplicates(["key_id", "key_hash"]), "searched") for b in range(blocks)]
        found = (reduce(DataFrame.unionByName, passes).groupBy("key_id", "key_hash")
                 .agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("runs"))).alias("runs"),
                      F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")))
        out = join_by_key(out.select("*", *row_key(id_col, text_col)), landed(found, "found"), "inner").drop("key_id", "key_hash")
        # the passes' runs may overlap
        merged = F.aggregate("runs", F.struct(F.lit(0).cast("long").alias("upto"), F.lit(0).cast("long").alias("n")),
                             lambda a, r: F.struct(F.greatest(a.upto, r["first"] + r["words"]).alias("upto"),
                                                   (a.n + F.greatest(r["first"] + r["words"] - F.greatest(a.upto, r["first"]), F.lit(0))).alias("n")),
                             lambda a: a.n)
    return (out.withColumn("n_hit", merged)
            .withColumn("contaminated", (F.col("n_hit") > 0) & (100 * F.col("n_hit") >= percent * F.col("n_words"))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


# The same by brute force: every 13-word window of documents and items, joined as text.
ORACLE = r"""
WITH dw AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
bw AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
pat AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i:i + 12], ' ') AS p
        FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM bw WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM pat),
win AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS p
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, win.n, item FROM win JOIN pat ON win.p = pat.p AND win.n = pat.n),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
