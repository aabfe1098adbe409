"""Quality classifier: ordinal regression with a cumulative link on graded ratings.

A document's grade is at most k with probability logistic(threshold_k - weights . features): one weight vector for all grades,
shared, and ordered thresholds between them. Features are hashed text: which words, runs of symbols and shape marks
(shares of capitals, digits, symbols, line ends and different words, each in doublings) occur, of 2**18. So a document has a
position on one scale, from which follow the probability of each grade, the expected grade and the tail
probabilities of reaching a grade.

The model is fitted on a bounded sample, at most ``MAX_RATED`` documents that have a rating, chosen by hash, on the driver. Their
features come from Spark tasks, of whole texts, as lists of different features; no text reaches the driver. Features whose
documents' mean grade is ``MIN_DEVIATIONS`` standard errors from the overall one, so that no chance word counts, full-batch accelerated gradients on the penalised likelihood. Half of the sample,
scored by a model of the other half, places the cut: documents are rejected whose expected grade lies below it. It is where the
shares on the wrong side, of the best grade below and of the others above, are least together, among the places that leave at most ``SPARED`` of the
best grade below; where the scores part the grades, that is in the middle between them. Weights (2**18 single-precision numbers, 1 MB) are broadcast; scoring is one pass.

Ratings are joined by id. Rows with a null id or a null rating are not learned from; a document rated twice counts twice. Without
ratings of at least two grades every document is kept, with the middle grade expected. Null and empty texts have no words and only shape
marks. Repeated rows are scored row by row; an empty table gives an empty result. Other columns pass through; input
columns named like an output are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.common import row_key, table
from paddock.llm.wordhash import FOLD, SLICE, byte_class, hashed_words, mixed

BITS = 18
MAX_RATED = 8000
MIN_DOCS, MIN_DEVIATIONS = 3, 4.0
SPARED = 0.01
PENALTY = 1.0
STEPS = 250

_WORD = byte_class([(0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)])
_SYMBOL = byte_class([(0x21, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x7F)])
_SHAPES = [byte_class([(0x41, 0x5B)]), byte_class([(0x30, 0x3A)]), _SYMBOL, byte_class([(0x0A, 0x0B)])]


def _buckets(kind: int, hashes: np.ndarray) -> np.ndarray:
    return (mixed(hashes * np.uint64(2 * kind + 0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every different feature, sorted; computed over about a slice of text at a time."""
    sizes = np.cumsum([len(t) for t in texts])
    parts, at = [], 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE)))
        rows, buckets = _features(texts[at:end])
        parts.append(((rows + at).astype(np.int32), buckets.astype(np.int32)))
        at = end
    if not parts:
        return np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int32)
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    folded = FOLD[raw]
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes + 1) - 1
    found, words = [], np.zeros(len(texts), dtype=np.int64)
    for kind, cls in enumerate((_WORD, _SYMBOL)):
        starts, _, hashes = hashed_words(folded, cls)
        of = np.searchsorted(ends, starts)
        if kind == 0:
            words = np.bincount(of, minlength=len(texts))
        found.append((of << BITS) | _buckets(kind, hashes))
    unique = np.unique(found[0])
    different = np.bincount(unique >> BITS, minlength=len(texts))
    shares = [different / np.maximum(1, words)]
    for cls in _SHAPES:
        upto = np.concatenate(([0], np.cumsum(cls[raw], dtype=np.int64)))
        shares.append((upto[ends] - upto[ends - sizes]) / np.maximum(1, sizes))
    every = np.arange(len(texts), dtype=np.int64)
    for kind, share in enumerate(shares):
        mark = np.ceil(np.log2(1 + 1000 * share)).astype(np.uint64)
        found.append((every << BITS) | _buckets(2 + kind, mark + np.uint64(1)))
    unique = np.unique(np.concatenate([unique, *found[1:]]))
    return unique >> BITS, unique & ((1 << BITS) - 1)


@dataclass
class OrdinalModel:
    """P(grade <= k) = logistic(thresholds[k] - weights . features)."""

    weights: np.ndarray
    thresholds: np.ndarray
    cut: float = float("-inf")

    def reaches(self, texts: np.ndarray, buckets: np.ndarray, n: int) -> np.ndarray:
        """Of each text, the probabilities of reaching grade 1, 2, ..."""
        z = np.bincount(texts, weights=self.weights[buckets], minlength=n)
        return 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - z[:, None], -500, 500)))


def fit(texts: np.ndarray, buckets: np.ndarray, grades: np.ndarray, n_grades: int) -> OrdinalModel:
    """The penalised maximum-likelihood model, by Nesterov's method with a falling step where it overshoots."""
    docs = np.bincount(buckets, minlength=1 << BITS)
    apart = np.bincount(buckets, weights=(grades - grades.mean())[texts], minlength=1 << BITS)
    use = np.flatnonzero((docs >= MIN_DOCS) & (np.abs(apart) >= MIN_DEVIATIONS * max(grades.std(), 1e-9) * np.sqrt(docs)))
    place = np.full(1 << BITS, -1, dtype=np.int32)
    place[use] = np.arange(len(use))
    known = place[buckets] >= 0
    rows, cols, n = texts[known], place[buckets[known]], len(grades)
    share = np.cumsum(np.bincount(grades, minlength=n_grades))[:-1] / n
    start = np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))
    w, first, gaps = np.zeros(len(use)), start[0], np.log(np.maximum(np.diff(start), 1e-2))
    x = np.concatenate((w, [first], gaps))
    scale = np.concatenate((np.sqrt(np.bincount(cols, minlength=len(use)) + 4 * PENALTY), np.full(n_grades - 1, np.sqrt(n))))

    def loss(x: np.ndarray):
        w, theta = x[: len(use)], x[len(use)] + np.concatenate(([0], np.cumsum(np.exp(x[len(use) + 1 :]))))
        z = np.bincount(rows, weights=w[cols], minlength=n)
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        with np.errstate(over="ignore"):
            upper, lower = 1 / (1 + np.exp(z - edges[grades + 1])), 1 / (1 + np.exp(z - edges[grades]))
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p, lower * (1 - lower) / p
        g_theta = np.array([(dl[grades == k + 1]).sum() - du[grades == k].sum() for k in range(n_grades - 1)])
        g_gaps = np.cumsum(g_theta[::-1])[::-1]
        g = np.concatenate((np.bincount(cols, weights=(du - dl)[rows], minlength=len(use)) + 2 * PENALTY * w, [g_gaps[0]], g_gaps[1:] * np.exp(x[len(use) + 1 :])))
        return -np.log(p).sum() + PENALTY * (w @ w), g / scale

    step, y, best, t = 0.25, x * scale, x * scale, 1.0
    value = loss(x)[0]
    for _ in range(STEPS):
        f, g = loss(y / scale)
        new = y - step * g
        f_new = loss(new / scale)[0]
        if f_new > f:
            step, t, y = step / 2, 1.0, best
            continue
        if f_new <= value:
            t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
            y, best, t = new + (t - 1) / t_next * (new - best), new, t_next
            if value - f_new < 1e-7 * abs(value):
                value = f_new
                break
            value = f_new
        else:
            y, t = best, 1.0  # momentum led uphill
    x = best / scale
    weights = np.zeros(1 << BITS, dtype=np.float32)
    weights[use] = x[: len(use)]
    return OrdinalModel(weights, x[len(use)] + np.concatenate(([0], np.cumsum(np.exp(x[len(use) + 1 :])))))


def place_cut(score: np.ndarray, best: np.ndarray) -> float:
    """The cut with the least share of the ``best`` below and of the others above, among those that leave at most
    ``SPARED`` of the best below; of equal ones the lowest."""
    values, of = np.unique(score, return_inverse=True)
    good, other = np.bincount(of[best], minlength=len(values)), np.bincount(of[~best], minlength=len(values))
    lost = np.cumsum(good) - good  # of the best, with a cut just below each value
    passed = other[::-1].cumsum()[::-1]
    at = int(np.argmin(np.where(lost <= SPARED * good.sum(), lost / good.sum() + passed / max(1, other.sum()), 3)))
    return float("-inf") if at == 0 else float((values[at - 1] + values[at]) / 2)


def fit_with_cut(texts: list[bytes], grades: np.ndarray, n_grades: int) -> OrdinalModel:
    """The model of all texts, with the cut from two halves that score each other."""
    return fit_features_with_cut(*features(texts), grades, n_grades)


def fit_features_with_cut(of: np.ndarray, buckets: np.ndarray, grades: np.ndarray, n_grades: int) -> OrdinalModel:
    """The same of (text, feature) pairs."""
    if len(np.unique(grades)) < 2:
        return OrdinalModel(np.zeros(1 << BITS, dtype=np.float32), np.zeros(n_grades - 1))
    n = len(grades)
    side = np.arange(n) % 2
    score = np.zeros(n)
    for s in (0, 1):
        learn, judge = np.flatnonzero(side == s), np.flatnonzero(side != s)
        place = np.zeros(n, dtype=np.int32)
        place[learn], place[judge] = np.arange(len(learn)), np.arange(len(judge))
        mine = side[of] == s
        half = fit(place[of[mine]], buckets[mine], grades[learn], n_grades)
        score[judge] = half.reaches(place[of[~mine]], buckets[~mine], len(judge)).sum(axis=1)
    model = fit(of, buckets, grades, n_grades)
    model.cut = place_cut(score, grades == grades.max())
    return model


def _feature_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts to the sorted different features of each."""
    for whole in batches:
        for at in range(0, whole.num_rows, 64):
            batch = whole.slice(at, 64)
            of, buckets = features([t.as_py().encode() for t in batch.column("text")])
            lists = np.split(buckets, np.searchsorted(of, np.arange(1, batch.num_rows)))
            yield pa.RecordBatch.from_arrays([batch.column("key_id"), batch.column("key_hash"), pa.array(lists, pa.list_(pa.int32()))], names=["key_id", "key_hash", "found"])


def learn(docs: DataFrame, ratings: DataFrame, grade: Column, n_grades: int, id_col: str = "doc_id", text_col: str = "text",
          max_rated: int = MAX_RATED) -> OrdinalModel:
    """Fit on at most ``max_rated`` rated documents; ``grade`` is an int column of ``ratings``, null where unknown."""
    rated = ratings.select(F.col(id_col).alias("id"), grade.cast("int").alias("grade")).where("id is not null and grade is not null")
    texts = docs.select(*row_key(id_col, text_col), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # chosen among ids and hashes of documents with a rating: at most max_rated rows, a repeated row as often as it is there
    chosen = (texts.select("key_id", "key_hash").join(rated, F.col("key_id") == F.col("id"))
              .orderBy(F.xxhash64("key_id"), "key_hash", "grade").limit(max_rated).select("key_id", "key_hash", "grade").toArrow())
    if not chosen.num_rows:
        return fit_with_cut([], np.zeros(0, dtype=np.int64), n_grades)
    keys = docs.sparkSession.createDataFrame(chosen).select("key_id", "key_hash").distinct()
    one = texts.join(F.broadcast(keys), ["key_id", "key_hash"]).dropDuplicates(["key_id", "key_hash"])
    kinds = f"key_id {texts.schema['key_id'].dataType.simpleString()}, key_hash bigint, found array<int>"
    lists = one.select("key_id", "key_hash", "text").mapInArrow(_feature_lists, kinds).toArrow()
    place = {k: i for i, k in enumerate(zip(lists.column("key_id").to_pylist(), lists.column("key_hash").to_pylist(), strict=True))}
    found = lists.column("found").combine_chunks()
    start, values = found.offsets.to_numpy(), found.values.to_numpy()
    at = np.array([place[k] for k in zip(chosen.column("key_id").to_pylist(), chosen.column("key_hash").to_pylist(), strict=True)])
    sizes = (start[1:] - start[:-1])[at]
    of = np.repeat(np.arange(len(at), dtype=np.int32), sizes)
    buckets = np.concatenate([values[start[i] : start[i + 1]] for i in at])
    return fit_features_with_cut(of, buckets, chosen.column("grade").to_numpy().astype(np.int64), n_grades)


ADDED = [T.StructField("expected_grade", T.DoubleType()), T.StructField("reaches", T.ArrayType(T.DoubleType())), T.StructField("kept", T.BooleanType())]

_workers: dict[str, OrdinalModel] = {}


def grade_documents(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """``docs`` with expected_grade, reaches (tail probabilities of grade 1, 2, ...) and kept."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop(*(f.name for f in ADDED))
    out = T.StructType([*docs.schema.fields, *ADDED])
    schema, name = to_arrow_schema(out), uuid.uuid4().hex
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if name not in _workers:
            _workers.clear()
            _workers[name] = shared.value
        model = _workers[name]
        for whole in batches:
            sizes = np.cumsum([len(t.as_py() or "") for t in whole.column(text_col)])
            at = 0
            while at < whole.num_rows:  # about a slice of text at once
                end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + SLICE)))
                batch = whole.slice(at, end - at)
                texts = [(t.as_py() or "").encode() for t in batch.column(text_col)]
                p = model.reaches(*features(texts), len(texts))
                grade = p.sum(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(grade), pa.array(list(p), pa.list_(pa.float64())), pa.array(grade >= model.cut)], schema=schema)
                at = end

    return docs.mapInArrow(score, out)


def label_grade() -> Column:
    """Grades of the labels table: 0 toxic, 1 of low quality, 2 good."""
    return F.when(F.col("toxic") == 1, 0).when((F.col("toxic") == 0) & F.col("quality").isin(0, 1), 1 + F.col("quality"))


def classified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return grade_documents(docs, learn(docs, table(spark, sf_dir, "labels"), label_grade(), 3))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = classified(spark, table(spark, sf_dir, "documents").select("doc_id", "text"), sf_dir)
    return out.select("doc_id", "expected_grade", F.col("reaches")[0].alias("p_not_toxic"), F.col("reaches")[1].alias("p_good"), "kept")
