"""The pipeline, stage by stage against brute force, on a fixture with planted cases."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline as cp
from paddock.llm import mixing, quality_classifier
from tests.llm import test_decontamination as decon
from tests.llm import test_near_dup as near
from tests.llm.test_tokens import ids

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def fixture(spark, tmp_path_factory):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(600)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    bench = [(i, text(rng.randrange(15, 40))) for i in range(12)]
    rows = [(i, text(rng.randrange(20, 200))) for i in range(150)]
    rows += [(200 + i, text(60) + " idiot scum trash " + text(20)) for i in range(30)]  # toxic
    base = text(120)
    rows += [(300 + i, base + f" end{i}") for i in range(20)] + [(330 + i, base) for i in range(5)]  # copies
    rows += [(400 + i, text(30) + " " + b + " " + text(10)) for i, b in bench]  # contaminated
    rows += [(500, None), (501, ""), (502, text(20_000)), (None, text(40)), (503, text(50)), (503, text(50)), (504, "rep eat")] + [(504, "rep eat")]
    out = [(i, t, None if i is None or i % 7 == 0 else "en", None if i is None or i % 11 == 0 else f"s{i % 4 if i % 3 else 0}", len(t or "")) for i, t in rows]
    labels = [(i, 1, 0) for i in range(0, 150, 2)] + [(200 + i, 1, 1) for i in range(0, 30, 2)] + [(None, 0, 1), (1, None, 0)]
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(out, COLUMNS).repartition(3).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return d, bench


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages(spark, fixture):
    d, bench = fixture
    docs = spark.read.parquet(f"{d}/documents.parquet")
    schema, stages = docs.schema, dict(cp.STAGES)

    step = cp.landed(stages["quality_classifier"](spark, docs, d), "t")
    assert step.columns == schema.names
    model = quality_classifier.learn(docs, spark.read.parquet(f"{d}/labels.parquet"), quality_classifier.label_grade(), 3)
    every = rows_of(docs)
    score = [model.reaches(*quality_classifier.features([(t or "").encode()]), 1).sum() for _, t in every]
    assert Counter(rows_of(step)) == Counter(r for r, s in zip(every, score, strict=True) if s >= model.cut)
    assert not any(i is not None and 200 <= i < 230 for i, _ in rows_of(step))
    assert sum(i is not None and i < 150 for i, _ in rows_of(step)) >= 147

    before = rows_of(step)
    step = cp.landed(stages["near_duplicates"](spark, step, d), "t")
    kept = Counter(i for i, _, _, k in near.brute(before, 5, 80) if k)
    assert Counter(str(i) for i, _ in set(rows_of(step))) == Counter({i: len({r for r in before if str(r[0]) == i and near.shingles(r[1], 5)} or {1}) if kept[i] > 1 else n for i, n in kept.items()})
    assert len(set(rows_of(step))) == len(rows_of(step)) and sum(i is not None and 300 <= i < 340 for i, _ in rows_of(step)) == 1

    before = rows_of(step)
    step = cp.landed(stages["decontamination"](spark, step, d), "t")
    clean = Counter(i for i, *_, bad in decon.brute(before, bench, 13) if not bad)
    assert Counter(str(i) for i, _ in rows_of(step)) == clean and not any(i is not None and 400 <= i < 412 for i, _ in rows_of(step))

    before = step
    step = cp.landed(stages["mixing"](spark, step, d), "t")
    assert step.columns == schema.names
    times = {(r.key_id, r.size): (2 * r.taken + r.size) // (2 * r.size) for r in mixing.mix(before).collect() if r.size}
    want = Counter({(i, t): times.get((i, len((t or "").split())), 0) for i, t in rows_of(before)})
    assert Counter(rows_of(step)) == +want

    before = sorted(rows_of(step), key=lambda r: (r[0] is not None, r[0] or 0))
    got = sorted(stages["token_output"](spark, step, d).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == [i for i, _ in before]
    crc = Counter((i, zlib.crc32(np.array(ids(t) + [2], dtype="<u4").tobytes())) for i, t in before)
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == crc
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert Counter(map(tuple, cp.run(spark, d).collect())) == Counter(map(tuple, got))


def test_empty_documents(spark, fixture):
    d, _ = fixture
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in cp.STAGES:
        docs = cp.landed(stage(spark, docs, d), "t")
    assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and docs.collect() == []
