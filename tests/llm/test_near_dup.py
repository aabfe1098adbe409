import random
import re

import numpy as np
import pytest

from paddock.llm import near_dup as nd
from paddock.llm.components import components


def shingles(text, k):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            c = len(sets[i] & sets[j])
            if c and 100 * c >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    groups = {}
    for i in range(len(rows)):
        groups.setdefault(find(i), []).append(i)
    out = []
    for members in groups.values():
        ids = [rows[i][0] for i in members if rows[i][0] is not None]
        least = min(ids) if ids else None
        out += [(str(rows[i][0]), len(sets[i]), str(least), rows[i][0] == least if least is not None else True) for i in members]
    return sorted(out)


def result(df):
    return sorted((str(r.key_id), r.n_shingles, str(r.component_id), r.kept) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(400)] + ["É", "漢字"]
    doc = lambda n: [rng.choice(vocab) for _ in range(n)]

    def edited(words, edits):
        words = list(words)
        for _ in range(edits):
            words[rng.randrange(len(words))] = rng.choice(vocab) + "x"
        return words

    out = [" ".join(doc(rng.randrange(1, 200))) for _ in range(60)]
    base = doc(150)
    out += [" ".join(edited(base, rng.randrange(0, 10))) for _ in range(120)]  # one large group of near copies
    other = doc(60)
    out += ["  ".join(edited(other, rng.randrange(0, 3))).upper() for _ in range(15)]
    out += ["exact copy of a text"] * 12 + ["", " \n", None, "one", "ONE", "two words", "a b c", "a b c d"]
    rows = list(enumerate(out))
    rng.shuffle(rows)
    return rows + [(None, "one"), (None, "only null id"), (None, "only null id"), (7, "again seven"), (rows[3][0], rows[3][1])]


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_against_brute_force(spark, rows, k, percent):
    docs = spark.createDataFrame([(i, t, "n") for i, t in rows], "doc_id long, text string, node string").repartition(3)
    assert result(nd.near_duplicates(docs, shingle=k, percent=percent)) == brute(rows, k, percent)


def test_band_recall_at_the_pipelines_threshold():
    rng = np.random.default_rng(31)
    shared = 0
    for _ in range(400):
        common, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (160, 20, 20))
        x, y = (nd.band_keys(nd.sketch(np.unique(np.concatenate([common, z])))) for z in (a, b))
        shared += bool(set(x.tolist()) & set(y.tolist()))
    assert shared == 400  # at 0.8 a pair is missed with probability 5e-5


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(docs).collect() == []
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert result(nd.near_duplicates(docs)) == [("1", 0, "1", True), ("2", 0, "2", True)]


def test_sketch_merges_and_estimates():
    rng = np.random.default_rng(4)
    a, b, c = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (300, 300, 2000))
    assert (nd.merged(nd.sketch(a), nd.sketch(b)) == nd.sketch(np.concatenate([a, b]))).all()
    same = [(nd.sketch(np.concatenate([c, a])) == nd.sketch(np.concatenate([c, b]))).mean()]
    assert abs(same[0] - 2000 / 2600) < 0.12
    grid = np.linspace(0.01, 0.99, 99)
    x, y = nd.sketch(np.concatenate([c, a])), nd.sketch(np.concatenate([c, b]))
    fit = nd.similarity_likelihood((x > y).sum(), (x < y).sum(), 2300.0, 2300.0, grid)
    assert abs(grid[fit.argmax()] - 2000 / 2600) < 0.12


def test_components(spark):
    rng = random.Random(2)
    order = list(range(300))
    rng.shuffle(order)
    links = list(zip(order, order[1:200], strict=False)) + [(1000, 1000 + i) for i in range(1, 50)] + [(5000, 5001), (5001, 5000)]
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(len, groups.values())) == [2, 50, 200]
    assert all(root in nodes for root, nodes in groups.items())
