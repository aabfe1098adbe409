"""Language identification by hyperdimensional profiles.

Every letter, and the gap between words, has a random vector of +1 and -1, drawn from a generator seeded by its code
point. An n-gram's vector binds its letters: the product of their vectors, each rotated by its place. A text's vector bundles
its n-grams: the sum over all of them inside words and at their edges. A language's prototype bundles the n-grams of its texts.
The language of a text is that of the prototype with the largest cosine, which is also the score (at least 0).

Prototypes are learned from all rows with a language and a text, a copied text as often as it occurs; each Spark task adds up
its share, others add up those by language and part, and then by language, one vector in memory at a time. The sums are
whole numbers, the same in any order. The table of prototypes is broadcast ``BROADCAST`` languages at once (32 MB); prediction
is one pass over whole texts for each such part, a single one for all languages that a corpus may well have.

A null text, or one without letters, is "und" with score 0, as is every text where no language could be learned. Texts with a null
language, and null texts, are not learned from. Ties go to the first language by name. Repeated rows are judged row by row; an empty table
gives an empty result. Other columns pass through; input columns named like an output are replaced.
"""

from __future__ import annotations

import functools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.common import landed, table

DIMS = 1024
PIECE_CHARS = 1 << 20
BROADCAST = 4096  # languages of a pass
UNKNOWN = "und"

_GAP = re.compile(r"[\W\d_]")


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@functools.lru_cache(maxsize=50_000)
def _letter_vector(code: int, dims: int) -> np.ndarray:
    return (2 * np.random.default_rng([20, code]).integers(0, 2, dims) - 1).astype(np.int8)


def ngram_vectors(grams: np.ndarray, letters: np.ndarray, dims: int) -> np.ndarray:
    """The bound vectors of n-grams, given as rows of places in ``letters`` (code points; 0 is the gap)."""
    of = np.array([_letter_vector(int(c), dims) for c in letters]).reshape(-1, dims)
    out = of[grams[:, -1]]
    for place in range(1, grams.shape[1]):
        out = out * np.roll(of, place, axis=1)[grams[:, -1 - place]]
    return out.astype(np.float32)


def bundles(texts: list[str], dims: int = DIMS) -> np.ndarray:
    """The bundled trigram vector of each text; 0 where it has no letter."""
    out = np.zeros((len(texts), dims))
    codes = np.frombuffer(("\n" + "\n".join(texts) + "\n").lower().encode("utf-32-le", "replace"), dtype=np.uint32)
    sizes = np.array([len(t.lower()) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 1)
    letter = _letters()[codes]
    stay = letter | np.concatenate(([True], letter[:-1]))  # one gap between words
    places, code = np.flatnonzero(stay), np.where(letter, codes, 0)[stay]
    middle = np.flatnonzero(letter[stay])
    if not len(middle):
        return out
    known = np.flatnonzero(np.bincount(code))
    ids = np.zeros(int(known[-1]) + 1, dtype=np.int64)
    ids[known] = np.arange(len(known))
    a, b, c = (ids[code[middle + k]] for k in (-1, 0, 1))
    n = len(known)
    gram = (a * n + b) * n + c
    if n**3 <= 1 << 22:
        different = np.flatnonzero(np.bincount(gram, minlength=1))
        column = np.zeros(int(different[-1]) + 1, dtype=np.int64)
        column[different] = np.arange(len(different))
        column = column[gram]
    else:
        different, column = np.unique(gram, return_inverse=True)
    of = np.searchsorted(ends, places[middle])
    for at in range(0, len(different), 8192):  # so many n-grams at once
        part = different[at : at + 8192]
        mine = (column >= at) & (column < at + len(part)) if len(different) > 8192 else slice(None)
        counts = np.bincount(of[mine] * len(part) + column[mine] - at, minlength=len(texts) * len(part)).reshape(len(texts), -1)
        vectors = ngram_vectors(np.stack([part // (n * n), part // n % n, part % n], axis=1), known, dims)
        out += counts.astype(np.float32) @ vectors
    return out


def _pieces(text: str) -> Iterator[str]:
    """A long text, cut between words where it can be."""
    at = 0
    while len(text) - at > PIECE_CHARS:
        m = _GAP.search(text, at + PIECE_CHARS, at + 2 * PIECE_CHARS)
        end = m.start() if m else at + 2 * PIECE_CHARS
        yield text[at:end]
        at = end
    yield text[at:]


def _bundled(texts: list[str | None], dims: int) -> np.ndarray:
    out = np.zeros((len(texts), dims))
    todo: list[str] = []
    of: list[int] = []

    def flush():
        if todo:
            np.add.at(out, of, bundles(todo, dims))
            todo.clear()
            of.clear()

    size = 0
    for i, text in enumerate(texts):
        for piece in _pieces(text or ""):
            if size + len(piece) > PIECE_CHARS:
                flush()
                size = 0
            todo.append(piece)
            of.append(i)
            size += len(piece)
    flush()
    return out


SUMS = "lang string, part int, total array<double>"


def _summed(vectors: Iterator[tuple[str, int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """The sum of each run of one language and part."""
    key, total = None, None

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"lang": [key[0]], "part": pa.array([key[1]], pa.int32()), "total": pa.array([total.tolist()], pa.list_(pa.float64()))})

    for lang, part, vector in vectors:
        if key == (lang, part):
            total = total + vector
            continue
        if key:
            yield row()
        key, total = (lang, part), vector
    if key:
        yield row()


def learn_profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", dims: int = DIMS, parts: int = 24) -> DataFrame:
    """lang and total, its prototype: a row for each language with letters; landed."""
    rated = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang is not null and text is not null")

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId() % parts
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                for lang, vector in zip(batch.column("lang").to_pylist(), _bundled(batch.column("text").to_pylist(), dims), strict=True):
                    sums[lang] = sums[lang] + vector if lang in sums else vector
                if len(sums) > BROADCAST:  # as many vectors are held at once
                    yield from _summed((k, part, v) for k, v in sums.items())
                    sums = {}
        yield from _summed((k, part, v) for k, v in sums.items())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _summed((r["lang"], r["part"], np.array(r["total"])) for batch in batches for r in batch.to_pylist())

    shares = rated.mapInArrow(bundle, SUMS)
    shares = shares.repartition("lang", "part").sortWithinPartitions("lang", "part").mapInArrow(add, SUMS).withColumn("part", F.lit(0))
    sums = shares.repartition("lang").sortWithinPartitions("lang").mapInArrow(add, SUMS)
    return landed(sums.where(F.exists("total", lambda x: x != 0)).select("lang", "total"), "profiles")


ADDED = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]

_workers: dict[str, tuple[list[str], np.ndarray]] = {}


def _passes(profiles: DataFrame) -> Iterator[dict[str, list[float]]]:
    """The prototypes by name, ``BROADCAST`` at a time."""
    while rows := profiles.orderBy("lang").limit(BROADCAST).collect():
        yield {r.lang: r.total for r in rows}
        profiles = profiles.where(F.col("lang") > rows[-1].lang)


def identify(docs: DataFrame, profiles: DataFrame, text_col: str = "text", dims: int = DIMS) -> DataFrame:
    """``docs`` with lang_pred and score."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop(*(f.name for f in ADDED))
    schema = to_arrow_schema(T.StructType([*docs.schema.fields, *ADDED]))
    out = docs.withColumns({ADDED[0].name: F.lit(UNKNOWN), ADDED[1].name: F.lit(0.0)})
    for part in _passes(profiles):
        out = out.mapInArrow(_better(docs.sparkSession.sparkContext.broadcast(part), schema, text_col, dims), out.schema)
    return out


def _better(shared, schema: pa.Schema, text_col: str, dims: int):
    """Rows with lang_pred and score, where one of the shared prototypes is closer than that of before."""
    name = uuid.uuid4().hex

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _workers:
            _workers.clear()
            vectors = np.array(list(shared.value.values())).reshape(-1, dims)
            _workers[name] = list(shared.value), vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        langs, vectors = _workers[name]
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                own = _bundled(batch.column(text_col).to_pylist(), dims)
                norms = np.linalg.norm(own, axis=1)
                lang = np.array(batch.column(ADDED[0].name).to_pylist(), dtype=object)
                score = batch.column(ADDED[1].name).to_numpy(zero_copy_only=False).copy()
                if some := np.flatnonzero(norms > 0).tolist():
                    cosine = own[some] @ vectors.T / norms[some, None]
                    best = cosine.argmax(axis=1)
                    found = np.clip(cosine[np.arange(len(best)), best], 0, 1)
                    for i, k, s in zip(some, best.tolist(), found.tolist(), strict=True):
                        if s > score[i] or lang[i] == UNKNOWN:
                            lang[i], score[i] = langs[k], s
                columns = [batch.column(f.name) for f in schema if f.name not in (ADDED[0].name, ADDED[1].name)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(lang, pa.string()), pa.array(score)], schema=schema)

    return predict


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    profiles = learn_profiles(docs.where(~held_out))
    return (identify(docs.select("doc_id", "text"), profiles)
            .select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"))
