"""Learned operators: the ordinal quality classifier and the language profiles."""

import random
import zlib

import numpy as np
import pytest

from paddock.llm import language_id as li
from paddock.llm import quality_classifier as qc

LARGE = "/root/testdata/sf0.1"


def test_fit_recovers_an_ordinal_model():
    rng = np.random.default_rng(3)
    weights = np.zeros(1 << qc.BITS)
    weights[:6] = [3, -3, 1.5, -1.5, 0, 0]
    has = rng.random((4000, 6)) < 0.4
    texts, buckets = np.nonzero(has)
    z = has @ weights[:6]
    grades = (z + rng.logistic(size=4000) > -0.5).astype(int) + (z + rng.logistic(size=4000) * 0 + rng.logistic(size=4000) > 2.0)
    model = qc.fit(texts, buckets, np.clip(grades, 0, 2), 3)
    assert np.corrcoef(model.weights[:6], weights[:6])[0, 1] > 0.98
    assert model.thresholds[0] < model.thresholds[1]
    p = model.reaches(texts, buckets, 4000)
    assert (p[:, 0] >= p[:, 1]).all() and abs(p[:, 0].mean() - (grades >= 1).mean()) < 0.03


def test_classifier_on_held_out_ratings(spark):
    docs = spark.read.parquet(f"{LARGE}/documents.parquet")
    labels = spark.read.parquet(f"{LARGE}/labels.parquet")
    model = qc.learn(docs, labels.where("doc_id % 2 = 0"), qc.label_grade(), 3, max_rated=2000)
    judged = qc.grade_documents(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), model).select("expected_grade", "kept", qc.label_grade().alias("grade")).collect()
    kept = {g: np.mean([r.kept for r in judged if r.grade == g]) for g in (0, 1, 2)}
    assert kept[2] > 0.98 and kept[0] < 0.12 and kept[1] < 0.12, kept
    assert np.corrcoef([r.expected_grade for r in judged], [r.grade for r in judged])[0, 1] > 0.8


def test_cut_of_separable_grades_loses_no_good_document():
    rng = np.random.default_rng(5)
    good, other = rng.uniform(1.5, 2, 1000), rng.uniform(0, 0.9, 300)
    cut = qc.place_cut(np.concatenate((good, other)), np.arange(1300) < 1000)
    assert other.max() < cut < good.min()
    mixed = np.concatenate((rng.normal(1, 1, 1000), rng.normal(0, 1, 3000)))
    assert (mixed[:1000] < qc.place_cut(mixed, np.arange(4000) < 1000)).mean() <= 0.01
    assert qc.place_cut(np.ones(5), np.arange(5) < 2) == float("-inf")
    word = {2: "good", 1: "low", 0: "bad"}
    grades = rng.permutation([2, 2, 1, 2, 0, 2, 2, 2] * 100)
    # good documents differ in how many words speak for them
    texts = [" ".join(f"{word[g]}{rng.integers(30)}" for _ in range(rng.integers(8, 40))).encode() for g in grades]
    model = qc.fit_with_cut(texts, grades, 3)
    kept = model.reaches(*qc.features(texts), len(texts)).sum(axis=1) >= model.cut
    assert kept[grades == 2].all() and kept[grades < 2].mean() < 0.02


def test_classifier_odd_rows(spark):
    rows = [(i, ("bad " if i % 2 else "good ") * 5 + f"w{i}", i) for i in range(60)] + [(None, None, 0), (100, "", 0), (101, "bad " * 30_000, 0), (7, "x", 0), (7, "x", 0)]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, expected_grade int, kept boolean")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(60)] + [(None, 1, 1), (5, None, 0), (5, 1, None), (5, 7, 0)], "doc_id long, quality int, toxic int")
    got = qc.grade_documents(docs, qc.learn(docs, labels, qc.label_grade(), 3)).collect()
    assert len(got) == len(rows) and len(got[0].reaches) == 2
    assert all(r.kept == (r.doc_id % 2 == 0) for r in got if r.doc_id is not None and r.doc_id < 60 and r.text != "x")
    none = qc.learn(docs, labels.limit(0), qc.label_grade(), 3)
    assert all(r.kept for r in qc.grade_documents(docs, none).collect())
    assert qc.grade_documents(docs.limit(0), none).collect() == []
    assert none.cut == float("-inf")


def test_classifier_learns_from_long_documents_and_rated_ones_only(spark):
    rows = [(i, " ".join([("bad" if i % 2 else "good")] * 9000 + [f"w{i}"])) for i in range(60)]
    docs = spark.createDataFrame([*rows, (3, rows[3][1])], "doc_id long, text string").repartition(3)
    own = [(i, 1 - i % 2, 0) for i in range(60)]
    labels = spark.createDataFrame(own + [(1000 + i, i % 2, 0) for i in range(5000)], "doc_id long, quality int, toxic int")
    model = qc.learn(docs, labels, qc.label_grade(), 3, max_rated=61)  # ratings without documents take no place
    judged = qc.grade_documents(docs, model).collect()
    assert all(r.kept == (r.doc_id % 2 == 0) for r in judged)
    every = qc.learn(docs, labels, qc.label_grade(), 3)
    order = sorted([*rows, rows[3]], key=lambda r: r[0])
    plain = qc.fit_with_cut([t.encode() for _, t in order], np.array([2 - i % 2 for i, _ in order]), 3)
    assert np.allclose(every.weights, plain.weights, atol=1e-3) and np.any(every.weights)


def test_language_held_out_accuracy(spark):
    rows = li.query(spark, LARGE).join(spark.read.parquet(f"{LARGE}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 10_000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.99
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_odd_rows(spark):
    rng = random.Random(1)
    text = {"aa": lambda: " ".join(rng.choice(["kato", "mika", "Tako"]) for _ in range(30)), "bb": lambda: " ".join(rng.choice(["grün", "ßtrb", "öhl"]) for _ in range(30))}
    rows = [(i, text[k](), k) for i, k in enumerate(["aa", "bb"] * 20)]
    odd = [(100, None, "aa"), (101, "", "bb"), (102, "123 !?", None), (103, "kato " * 300_000, None), (104, "grün", None), (None, "mika Tako", None), (105, "漢字", None), (104, "grün", "x")]
    docs = spark.createDataFrame([(*r, 1) for r in rows + odd], "doc_id long, text string, lang string, score int")
    profiles = li.learn_profiles(docs.where("lang in ('aa', 'bb')"))
    got = {(r.doc_id, r.text): (r.lang_pred, r.score) for r in li.identify(docs, profiles).collect()}
    assert sorted(r.lang for r in profiles.collect()) == ["aa", "bb"]
    assert all(got[i, t][0] == k for i, t, k in rows)
    assert [got[i, t][0] for i, t, _ in odd[:6]] == ["und", "und", "und", "aa", "bb", "aa"] and got[100, None][1] == 0.0
    assert got[105, "漢字"][0] in ("aa", "bb")
    none = li.learn_profiles(docs.limit(0))
    assert none.collect() == []
    assert {r.lang_pred for r in li.identify(docs, none).collect()} == {"und"} and li.identify(docs.limit(0), profiles).collect() == []


def test_language_of_copies_is_learned(spark):
    words = [f"{a}{b}m{a}" for a in "bdfgklnp" for b in "aeiou"]
    rows = [(f"l{k}", " ".join(words[5 * k : 5 * k + 5])) for k in range(8)]
    docs = spark.createDataFrame(rows, "lang string, text string").crossJoin(spark.range(0, 20_000, 1, 4)).select("lang", "text")
    one = ("l0", "another text of the first one")
    profiles = li.learn_profiles(docs.union(spark.createDataFrame([one], "lang string, text string")))
    profiles = {r.lang: np.array(r.total) for r in profiles.collect()}
    assert sorted(profiles) == [lang for lang, _ in rows]
    for k, (lang, text) in enumerate(rows):
        assert (profiles[lang] == 20_000 * li.bundles([text])[0] + (k == 0) * li.bundles([one[1]])[0]).all()


def test_any_number_of_languages(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(i, f"l{i:04}", " ".join("".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(6)) for _ in range(3))) for i in range(5000)]
    docs = spark.createDataFrame([*rows, (6000, None, rows[0][2]), (6001, None, None)], "doc_id long, lang string, text string").repartition(4)
    got = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(docs, li.learn_profiles(docs)).collect()}
    assert all(got[i][0] == lang and got[i][1] > 0.999 for i, lang, _ in rows) and got[6000][0] == "l0000" and got[6001] == ("und", 0.0)
    some = docs.where("doc_id < 40 or doc_id >= 6000")
    found = lambda: sorted((r.doc_id, r.lang_pred, round(r.score, 9)) for r in li.identify(some, li.learn_profiles(some)).collect())
    want = found()
    monkeypatch.setattr(li, "BROADCAST", 7)
    assert found() == want


def test_prediction_is_the_largest_cosine(spark):
    rng = random.Random(12)
    texts = ["".join(rng.choice("abc é") for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    docs = spark.createDataFrame([(i, t, "xyz"[i % 3]) for i, t in enumerate(texts)] + [(100, "ab ab", "z2"), (101, "ab ab", "z1")], "doc_id long, text string, lang string")
    sums = {}
    for r in docs.collect():
        sums[r.lang] = sums.get(r.lang, 0) + li.bundles([r.text])[0]
    unit = lambda v: v / np.linalg.norm(v)
    for r in li.identify(docs, li.learn_profiles(docs)).collect():
        own = li.bundles([r.text])[0]
        if not own.any():
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        found = {k: unit(own) @ unit(v) for k, v in sums.items()}
        assert abs(r.score - max(0, max(found.values()))) < 1e-9 and found[r.lang_pred] > max(found.values()) - 1e-9
        if r.doc_id >= 100:
            assert r.lang_pred == "z1"  # equal prototypes: the first by name


def test_bundle_is_the_sum_of_bound_ngrams(monkeypatch):
    vec = lambda c: li._letter_vector(ord(c) if c else 0, 64).astype(float)
    gram = lambda a, b, c: np.roll(vec(a), 2) * np.roll(vec(b), 1) * vec(c)
    want = gram("", "a", "b") + gram("a", "b", "") + gram("", "é", "")
    assert (li.bundles(["Ab, É", "", "x"], 64)[0] == want).all() and not li.bundles(["", "1"], 64).any()
    words = " ".join(["some", "wörds", "and", "more"] * 40)
    whole = li._bundled([words, None], 64)
    monkeypatch.setattr(li, "PIECE_CHARS", 50)
    assert (li._bundled([words, None], 64) == whole).all()


@pytest.mark.parametrize("n", [0, 1, 5])
def test_features_are_per_text(n):
    texts = [b"Some words, and $$$ more\nwords", b"", "ünï 漢 AB".encode(), b"x" * 40, b"1 2 3"][:n]
    rows, cols = qc.features(texts) if n else (np.array([]), np.array([]))
    for i, t in enumerate(texts):
        assert sorted(cols[rows == i]) == sorted(qc.features([t])[1])
