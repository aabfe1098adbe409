import random
import re

import numpy as np
import pytest

from paddock.llm import mixing


def targets(sizes, weights=(5, 2, 1), most=3):
    """By the definition: share, stop at the limit, share the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in full]
        rest, w = total - sum(full.values()), sum(weight[s] for s in free)
        share = {s: rest * weight[s] / w for s in free}
        over = {s: float(most * sizes[s]) for s in free if share[s] >= most * sizes[s]}
        if not over:
            return {**full, **share}
        full |= over


def test_mix(spark):
    rng = random.Random(8)
    text = lambda n: " ".join("w" * rng.randrange(1, 5) for _ in range(n))
    names = ["b", "a", "Z", "é", None, "", "tiny", "hot"]
    rows = [(i, text(rng.randrange(1, 80)), "hot" if i % 3 == 0 else rng.choice(names)) for i in range(900)]
    rows += [(1000, None, "a"), (1001, "", "only empty"), (1002, " \t", "b"), (None, text(5), "a"), (None, text(5), "a"), (5, "rep eat", "b"), (5, "rep eat", "b"),
             (1003, text(20_000), "é"), (1004, "nul l one word", "Z"), (1005, "x", "one word")]
    docs = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, text string, source string, target string").repartition(4)
    got = mixing.mix(docs).collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    assert sorted((str(r.key_id), r.size, str(r.source)) for r in got) == sorted((str(i), size(t), str(s)) for i, t, s in rows)
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want, taken = targets(sizes), {}
    for r in got:
        assert abs(r.target - want[r.source]) <= 1e-9 * max(1, r.target) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(taken[s] == int(want[s] + 1e-6) for s in want), (taken, want)
    for block in (16, 1 << 20):  # the block gives the order, not what is taken
        assert sorted(map(tuple, mixing.mix(docs, block=block).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str) == sorted(map(tuple, got), key=str)


def test_schedule_stays_close_to_targets_throughout(spark):
    rows = spark.createDataFrame([(i, "w " * 50, s) for i, s in enumerate("aab" * 100 + "cccc" * 50)], "doc_id long, text string, source string")
    sized = mixing.sized(rows)
    total = sized.groupBy().sum("size").first()[0]
    sources = mixing.with_targets(sized, total, (5, 2, 1), 3)
    share = {r.sid: r.target / total for r in sources.collect()}
    n = -(-total // 32)
    slots = sorted((r.slot, r.sid, r["rank"], r.words) for r in mixing.schedule(spark, sources, total, 32).collect())
    for m in (40, 200, 700):
        for sid, p in share.items():
            assert abs(sum(1 for s in slots[:m] if s[1] == sid) - m * p) <= 6
    for r in sources.collect():
        own = [s for s in slots if s[1] == r.sid]
        assert [s[2] for s in own] == list(range(len(own))) and sum(s[3] for s in own) == int(r.target)
        blocks = -(-r.source_size // 32)
        assert all(s[3] == 32 for s in own[:-1] if s[2] % blocks < blocks - 1) and sum(s[0] == n for s in own) <= 6


def test_sources_of_any_size_reach_their_targets(spark):
    sizes = {f"s{n:04}": n for n in (1, 50, 100, 200, 400, 800, 1500, 3000, 5000)} | {"x": 400_000, "y": 600_000}
    rows = [(f"{s}-{at}", min(200, n - at), s) for s, n in sizes.items() for at in range(0, n, 200)]
    docs = spark.createDataFrame(rows, "doc_id string, n int, source string").selectExpr("doc_id", "repeat('w ', n) AS text", "source")
    want = targets(sizes)
    for block in (1024, mixing.BLOCK):
        taken = {}
        for r in mixing.mix(docs, block=block).collect():
            assert 0 <= r.taken <= 3 * r.size
            taken[r.source] = taken.get(r.source, 0) + r.taken
        assert taken == {s: int(want[s] + 1e-6) for s in sizes}


def test_repeated_rows_share_the_stream(spark):
    rows = [(7, "a b c", "hot")] * 3000 + [(None, "d e", "hot")] * 500 + [(i, "w " * 9, "cold") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(docs).collect()
    want = targets({"hot": 10_000, "cold": 450})
    assert len(got) == len(rows) and sum(r.taken for r in got if r.source == "hot") == int(want["hot"])
    assert {r.taken for r in got if r.source == "hot" and r.key_id == 7} <= {0, 1, 2, 3} and sum(r.taken for r in got if r.source == "cold") == int(want["cold"])


@pytest.mark.parametrize("n", [1 << 10, 1 << 18, 1 << 23])
def test_points_stay_even(spark, n):
    slots = spark.range(n).withColumnRenamed("id", "slot")
    points = np.sort(slots.select(mixing.point().alias("point")).toArrow().column("point").to_numpy())
    assert points[0] >= 0 and points[-1] < mixing.TURN
    assert np.diff(np.append(points, points[0] + mixing.TURN)).max() < 2 * mixing.TURN / n
    some = slots.where("slot % 1009 = 7").select("slot", mixing.point().alias("point")).collect()
    assert all(r.point == (r.slot * mixing.STEP % (1 << 62)) >> 31 for r in some)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mixing.mix(docs).collect() == []
    docs = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert sorted((r.key_id, r.size, r.target, r.taken) for r in mixing.mix(docs).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]
