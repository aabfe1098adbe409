import random
import re

from paddock.llm import quality_rules as qr


def base(text):
    t = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", t)
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i : i + 3]), []).append(i)
    places = {p + k for v in grams.values() if len(v) > 1 for p in v for k in range(3)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(places)


def test_figures_and_verdict(spark):
    rng = random.Random(6)
    text = lambda n: " ".join("ab" * rng.randrange(1, 4) + str(rng.randrange(500)) for _ in range(n))
    rows = [(i, text(rng.randrange(50, 120)), "en", "s") for i in range(80)]
    rows += [(100, None, "en", "s"), (101, "", None, None), (102, "a b c a b c", "en", None), (103, "x\n\nx\n \nx y\nx", "en", "s"),
             (104, "# $ % é漢 |<>", None, "s"), (105, text(60).replace(" ", "$$$ "), "en", "s"), (106, ("line of words here\n" * 30), "en", "s"),
             (107, "same " * 200, "de", "t"), (108, "\x0b\x0c\t", "de", "t"), (109, "t w o  t w o  t w o t w", "de", "t"), (110, text(20_000), "en", "s"),
             (None, text(60), "en", "s"), (None, text(60), "en", "s"), (111, "long" * 30 + " " + "wordswordswordswordswords" * 8 + " " + " ".join("q" * 90 + str(i) for i in range(70)), "en", "s"), (112, text(70), "xx", "rare")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, lang string, source string, n_words int").repartition(3)
    got = qr.judge(docs, carry=("doc_id", "text")).collect()
    assert len(got) == len(rows)
    for r in got:
        n, c, s, d, p = base(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, c, s, d, p), r.doc_id
        assert r.base_failed == (n < 50 or 100 * p > 50 * n)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i in range(80)) and kept[110] and kept[112] and kept[None]
    assert not any(kept[i] for i in (100, 101, 102, 103, 104, 105, 106, 107, 108, 109, 111))
    assert qr.judge(docs.limit(0)).collect() == []


def test_sketch_quartiles(spark):
    values = [7 * i % 5003 for i in range(4000)]
    rows = spark.createDataFrame([("en", str(v % 3), 1, v) for v in values], "lang string, source string, n_words int, _v long")
    for m in qr.MEASURES:
        rows = rows.withColumn(f"_{m}", rows._v)
    merged = qr.merged(qr.sketches(rows))
    f = {r.measure: r for r in qr.fences(merged, [], 0).collect()}
    exact = sorted(values)[2999]
    assert abs(f["symbols"].high - 100 - exact) <= exact / 100 and f["symbols"].rows == 4000
    assert sum(r.n for r in merged.where("measure = 'repeats'").collect()) == 4000
