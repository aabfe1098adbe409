import random
import re

import pytest

from paddock.llm import decontamination as dc

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, bench, window):
    pats = {}
    for item, text in bench:
        w = words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            pats.setdefault(tuple(w[i : i + window]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        w, hit, items = words(text), set(), set()
        for p, ids in pats.items():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit |= {*range(i, i + len(p))}
                    items |= ids
        out.append((str(doc), len(w), len(hit), tuple(sorted(items)), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def rows(df):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, tuple(r["items"]), r.contaminated) for r in df.collect())


@pytest.fixture(scope="module")
def data():
    rng = random.Random(3)
    vocab = ["the", "of", "and", "a", "Für", "é", "x1", "漢字", "to", "in"]
    text = lambda n: "".join(rng.choice(vocab) + rng.choice([" ", ", ", "\n", "--", " The "]) for _ in range(n))
    bench = [(i, text(rng.randrange(13, 40))) for i in range(30)] + [(40, "Solo"), (41, "two words"), (42, ""), (43, None), (44, "!!"), (None, text(14)), (3, text(20)), (45, "a " * 30)]
    docs = [(i, text(rng.randrange(0, 300))) for i in range(40)]
    docs += [(100 + i, text(rng.randrange(0, 400)) + bench[i][1].upper().replace(" ", " ;; ") + text(9)) for i in range(20)]
    docs += [(200, None), (201, ""), (202, "..."), (203, "solo"), (204, "x two, words y"), (205, bench[0][1]), (205, bench[0][1]), (None, bench[1][1]), (206, text(3000) + bench[2][1]), (207, "a a " * 40)]
    return docs, bench


def frames(spark, docs, bench):
    return (spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, items string").repartition(2),
            spark.createDataFrame(bench, "item_id long, text string"))


@pytest.mark.parametrize("window, block", [(13, 200_000), (13, 150), (5, 200_000)])
def test_against_brute_force(spark, data, window, block):
    d, b = frames(spark, *data)
    assert rows(dc.find_contamination(d, b, window=window, block_patterns=block)) == brute(*data, window)


def test_passes_bound_the_broadcast_and_write_no_text(spark, data, monkeypatch):
    docs, bench = data[0] + [(300, "x" * 5000 + " and " + "y" * 3000)], data[1] + [(60, "x" * 5000 + " and " + "y" * 3000)]
    d, b = frames(spark, docs, bench)
    landed, sent = [], []
    keep = dc.landed
    monkeypatch.setattr(dc, "landed", lambda df, purpose: landed.append((purpose, df.columns)) or keep(df, purpose))
    spread = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda sc, v: sent.append(sum(len(p) + len(i) for p, _, i in v)) or spread(sc, v))
    assert rows(dc.find_contamination(d, b, block_bytes=9000)) == brute(docs, bench, 13)
    assert len(sent) > 3 and max(sent) < 9000 + 8100
    searched = [c for p, c in landed if p == "searched"]
    assert len(searched) == len(sent) and all(c == ["key_id", "key_hash", "n_words", "runs", "items"] for c in searched)
    assert ("found", ["key_id", "key_hash", "n_words", "runs", "items"]) in landed


def test_empty_inputs(spark, data):
    docs, bench = data
    d, b = frames(spark, docs, [])
    assert rows(dc.find_contamination(d, b)) == brute(docs, [], 13)
    d, b = frames(spark, [], bench)
    assert rows(dc.find_contamination(d, b)) == []


def test_words_across_slices(monkeypatch):
    import numpy as np

    from paddock.llm import wordhash

    text = wordhash.FOLD[np.frombuffer(("Some words, é and 漢字 " * 50).encode(), dtype=np.uint8)]
    whole = wordhash.hashed_words(text, dc._IS_WORD)
    monkeypatch.setattr(wordhash, "SLICE", 7)
    assert all((a == b).all() for a, b in zip(whole, wordhash.hashed_words(text, dc._IS_WORD), strict=True))
