import hashlib
import random

import numpy as np

from paddock.llm import common
from paddock.llm import suffix_dedup as sd
from paddock.session import path_exists


def brute(rows, window):
    """Per row: removed flags, by the definition."""
    raws = [(t or "").encode() for _, t in rows]
    seen = {}
    for r in raws:
        for p in range(len(r) - window + 1):
            seen[r[p : p + window]] = seen.get(r[p : p + window], 0) + 1
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, dtype=int)
        for p in range(len(r) - window + 1):
            if seen[r[p : p + window]] > 1:
                gone[p : p + window] = 1
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append((len(r) - len(kept), int((np.diff(np.concatenate(([0], gone[:-1]))) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def check(spark, rows, window):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, spans string, removed int")
    got = sd.remove_repeats(docs.repartition(3), window=window).collect()
    assert len(got) == len(rows)
    have = sorted((str(r.doc_id), r.text or "", len((r.text or "").encode()) - len(r.kept), len(r.removed), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in got)
    want = sorted((str(i), t or "", *b) for (i, t), b in zip(rows, brute(rows, window), strict=True))
    assert have == want


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(5)
    words = ["alpha", "bé", "gamma", "delta", "eps", "ζ", "eta", "漢字", "iota"]
    text = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    passage, long = text(60), text(500)
    rows = [(i, text(rng.randrange(1, 120))) for i in range(25)]
    rows += [(100 + i, text(20) + passage + text(20)) for i in range(6)]  # shared passages
    rows += [(200 + i, long[: 700 + 3 * i] + "#" + long[703 + 3 * i :]) for i in range(8)]  # near copies
    rows += [(300, long), (301, long), (301, long), (None, passage), (None, passage), (None, None), (303, None), (304, "")]
    rows += [(305, "ab" * 600), (306, "z" * 900), (307, passage + "!" + passage), (308, long[:100]), (309, text(30) * 3)]
    check(spark, rows, 96)


def test_pieces_of_a_long_text(spark, monkeypatch):
    monkeypatch.setattr(sd, "PIECE", 1000)
    rng = np.random.default_rng(1)
    raw = "".join(map(chr, rng.integers(97, 123, 6000)))
    data = np.frombuffer(raw.encode(), dtype=np.uint8)
    whole = sd.segments(data, np.array([len(data)]), 96)
    assert whole["n"].sum() == len(raw) - 95 and whole["n"].max() <= 96 - sd.GRAM + 1
    emitted = [b for b in sd._scan(96)(iter([sd.pa.RecordBatch.from_pylist([{"key_id": 1, "key_hash": 2, "text": raw}])]))]
    starts = [p for b in emitted for lo, n in zip(b.column("lo").to_pylist(), b.column("n").to_pylist(), strict=True) for p in range(lo, lo + n)]
    assert starts == list(range(len(raw) - 95))


def test_structured_texts_do_not_collide(spark):
    """Thue-Morse strings and their complements have equal polynomial hashes modulo 2**64, whatever the bases."""
    tm = "".join("0b"[i.bit_count() % 2] for i in range(512))
    other = tm.translate(str.maketrans("0b", "b0"))
    check(spark, [(1, tm), (2, other), (3, "x" + tm[:300]), (4, None)], 512)
    check(spark, [(1, tm), (2, other), (3, tm)], 512)


def test_fingerprints_by_definition():
    h, rng = sd.Hasher(40000), np.random.default_rng(2)
    p = int(sd.PRIME)
    a = np.append(rng.integers(0, p, 1000, dtype=np.uint64), [p - 1, p - 1, 0]).astype(np.uint64)
    b = np.append(rng.integers(0, p, 1000, dtype=np.uint64), [p - 1, 1, p - 1]).astype(np.uint64)
    assert sd._product(a, b).tolist() == [x * y % p for x, y in zip(a.tolist(), b.tolist(), strict=True)]
    data = np.full(40000, 255, dtype=np.uint8)  # over two blocks
    for j in (0, 1):
        base = int(h.powers[j][0][1]) + (int(h.powers[j][1][1]) << 31)
        assert h.sums(data, j)[-1] == sum(256 * pow(base, i, p) for i in range(40000)) % p
        assert len(set(h.of(h.sums(data, j), np.arange(30000), np.arange(30000) + 2000, j).tolist())) == 1


def test_empty_and_unique(spark):
    check(spark, [], 400)
    check(spark, [(1, "no repeat here " + "".join(chr(200 + i) for i in range(500)))], 400)


def test_a_pass_leaves_no_shuffle_files(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(str(rng.randrange(10**6)) for _ in range(n))
    passage = text(40)
    docs = spark.createDataFrame([(i, text(30) + passage + text(30)) for i in range(20)], "doc_id long, text string").repartition(3)
    kept_files = lambda: {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()) if f.getName().startswith("shuffle_")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    spark.conf.set(setting, "false")
    before = kept_files()
    with common.watched() as paths:
        spans = sd.repeated_spans(docs, window=96)
    assert kept_files() <= before
    assert spark.conf.get(setting) == "false"
    spark.conf.unset(setting)
    left = {p.rpartition("/")[2].rpartition("-")[0] for p in paths if path_exists(spark, p)}
    assert not left & {"segments", "cells", "open", "digits"}
    assert spans.count()
