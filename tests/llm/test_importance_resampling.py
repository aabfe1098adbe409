import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from paddock.llm import importance_resampling as ir


def features(text):
    words = re.findall("[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def expected(docs, target):
    s, t = (Counter(b for x in texts for b in features(x)[1]) for texts in ([d[1] for d in docs], target))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000))))
    rows = []
    for i, text in docs:
        words, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words) >= 20))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = 25 * len(order) // 100
    return sorted(map(str, [(*r[:4], n + 1 if n < drawn else None) for n, r in enumerate(order)] + [(*r[:4], None) for r in rows if not r[4]]))


def text_of(rng, n):
    words = ["Alpha", "beta", "GAMMA", "été", "漢字", "x1", "den", "und", "z" * 70, "q"]
    return "".join(rng.choice(words) + str(rng.randrange(4)) + rng.choice([" ", "\n", ", ", "\n\n", "-", " \n "]) for _ in range(n))


def result(df):
    return sorted(map(str, ((r.key_id, r.n_features, r.weight, r.score, r.rank) for r in df.collect())))


def test_against_brute_force(spark):
    rng = random.Random(6)
    docs = [(i, text_of(rng, rng.randrange(60))) for i in range(200)]
    docs += [(300 + i, "The same line, often.\n" * (i % 7) + text_of(rng, 15)) for i in range(60)]
    docs += [(400, None), (401, ""), (402, "\n \n"), (403, "one"), (404, "one\n\ntwo"), (405, "a " * 100_000), (406, "b" * 300_000)]
    docs += [(None, text_of(rng, 30))] * 3 + [(500, docs[5][1] + " w" * 30)] * 30 + [(501, "﻿ été\r\nx y")]
    target = [text_of(rng, 40) for _ in range(20)] + [None, ""]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, times int, line string").repartition(3)
    want = spark.createDataFrame([(t, 2) for t in target], "text string, times int")
    assert result(ir.resample(df, want)) == expected(docs, target)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a " * 30), (2, "b " * 40)], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    assert ir.resample(none, docs).collect() == []
    assert result(ir.resample(docs, none)) == expected([(1, "a " * 30), (2, "b " * 40)], [])


def test_parts_make_up_the_text():
    rng = random.Random(2)
    for _ in range(50):
        raw = text_of(rng, rng.randrange(40)).encode()
        n, lines, crossing = ir.document_parts(raw)
        found = Counter(crossing.tolist())
        for line, buckets in zip(lines, ir.line_features(list(lines)), strict=True):
            for b in buckets.tolist():
                found[b] += lines[line]
        words, want = features(raw.decode())
        assert (n, found) == (len(words), Counter(want))


def test_line_features_keep_places():
    assert [x.tolist() for x in ir.line_features([b"", b"A b", b"", b"--", b"c"])] == [
        [], [zlib.crc32(x) % 10000 for x in (b"a", b"b", b"a b")], [], [], [zlib.crc32(b"c") % 10000]]


def test_ranks_are_places(spark):
    docs = spark.createDataFrame([(i % 50, "word " * 25 + str(i % 50)) for i in range(400)], "doc_id long, text string")
    ranks = [r.rank for r in ir.resample(docs, docs).collect() if r.rank is not None]
    assert sorted(ranks) == list(range(1, 101))
    assert np.all(ir.gains_of(np.zeros(10000, dtype=int), np.zeros(10000, dtype=int)) == 0)
