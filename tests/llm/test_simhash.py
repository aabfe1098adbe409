import random
import re

import numpy as np
import pytest
import xxhash

from paddock.llm import simhash as sh


def slow_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(values, distance=4):
    """The place of the first member of each value's component, by comparing all pairs."""
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, x in enumerate(values):
        for j in range(i):
            if (x ^ values[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)] + ["É", "漢字"]
    base = [rng.choice(vocab) for _ in range(400)]

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        return "\t".join(words).upper()

    texts = [edited(base, rng.randrange(12)) for _ in range(80)] + [" ".join(rng.choices(vocab, k=rng.randrange(1, 30))) for _ in range(120)]
    texts += ["one two\n", "ONE  two", "a", "", " \x0b", None, "three of us", "x " * 40_000] + ["same text of five words"] * 6
    ids = rng.sample(range(1000), len(texts))
    rows = [*zip(ids, texts, strict=True), (None, "one two"), (None, "nothing like this one"), (None, "nothing like this one"), (ids[3], texts[3])]
    prints = [slow_fingerprint(t) for _, t in rows]
    first = classes(prints)
    least = {}
    for (i, _), c in zip(rows, first, strict=True):
        least[c] = min((x for x in (least.get(c), i) if x is not None), default=None)
    df = spark.createDataFrame([(i, t, 0, "z") for i, t in rows], "doc_id long, text string, fp int, root string").repartition(3)
    got = sorted((str(r.key_id), r.fingerprint, str(r.component_id)) for r in sh.near_duplicates(df).collect())
    assert got == sorted((str(i), f"{p:016x}", str(least[c])) for (i, _), p, c in zip(rows, prints, first, strict=True))
    assert len(set(prints)) > len(set(first)) + 20


@pytest.mark.parametrize("large", [4, sh.LARGE])
def test_links_of_fingerprints(spark, large):
    rng = random.Random(large)
    near = lambda x, n: x ^ sum(1 << b for b in rng.sample(range(64), n))
    values = [rng.getrandbits(64) for _ in range(200)]
    values += [near(rng.choice(values), rng.randrange(1, 8)) for _ in range(400)]
    tail = rng.getrandbits(40) << 24  # many that share the high blocks of bits and are not near
    values += [tail | rng.getrandbits(24) for _ in range(300)]
    values = list(dict.fromkeys(values))
    signed = [int(v) for v in np.array(values, dtype=np.uint64).view(np.int64)]
    links = sh.links(spark.createDataFrame([(v,) for v in signed], "fp long"), large=large).collect()
    number = {v: i for i, v in enumerate(signed)}
    assert all((values[number[r.a]] ^ values[number[r.b]]).bit_count() <= 4 for r in links)
    root = list(range(len(values)))
    for _ in range(len(values)):
        before = list(root)
        for r in links:
            a, b = number[r.a], number[r.b]
            root[a] = root[b] = min(root[a], root[b])
        if before == root:
            break
    assert root == classes(values)


def test_buckets_hold_every_link(spark):
    rng = random.Random(8)
    base = rng.getrandbits(64)
    values = [base] + [base ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 6))) for _ in range(150)]
    values = list(dict.fromkeys(values))
    signed = [int(v) for v in np.array(values, dtype=np.uint64).view(np.int64)]
    for large in (2, 20, 1000):
        shared = {}
        for r in sh._buckets(spark.createDataFrame([(v,) for v in signed], "fp long"), 4, large).collect():
            shared.setdefault(r.fp, set()).add(r.bucket)
        for i, x in enumerate(values):
            for j in range(i):
                if (x ^ values[j]).bit_count() <= 4:
                    assert shared[signed[i]] & shared[signed[j]]


def test_empty(spark):
    assert sh.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    got = sh.near_duplicates(spark.createDataFrame([(2, None), (1, "")], "doc_id long, text string")).collect()
    assert sorted(map(tuple, got)) == [(1, "0" * 16, 1), (2, "0" * 16, 1)]
