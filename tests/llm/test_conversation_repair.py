import functools
import hashlib
import itertools
import random
import re

import pytest

from paddock.llm import conversation_repair as cr

ENDS = re.compile("(s?(ua)+)?")


def faults(rows):
    """(blank, duplicate or truncated, or None) of each row in order."""
    out, seen = [], set()
    for role, text in rows:
        body = re.findall("[^\x20\x09-\x0d]", text)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute(rows):
    """(cost, audit, messages) by a plain recursion over rows, states and inserts in a row, least audit on ties."""
    bad = faults(rows)

    @functools.cache
    def best(i, state, inserted=0):
        found = [(0, "", ())] if i == len(rows) and state in "0a" else [(10**9, "", ())]
        to = "a" if state == "u" else "u"
        name = "assistant" if to == "a" else "user"
        edits = [(2, "I", (name, ""), i, to, inserted + 1)] if inserted < 2 else []
        if i < len(rows):
            role, text = rows[i]
            edits.append((3, "D", None, i + 1, state, 0))
            if bad[i] in (None, "truncated"):
                extra = bad[i] == "truncated"
                edits.append((2 + extra, "R", (name, text), i + 1, to, 0))
                if role[:1] == to or (role[:1] == "s" and state == "0"):
                    edits.append((extra, "K", (role, text), i + 1, role[:1], 0))
        for cost, op, message, *then in edits:
            c, s, m = best(*then)
            found.append((cost + c, op + s, (message, *m) if message else m))
        return min(found, key=lambda f: f[:2])

    for i in range(len(rows), 0, -50):
        [best(i, s, n) for s in "0sua" for n in (2, 1, 0)]
    return best(0, "0")


def exhaustive(rows):
    """The same by trying all edits of a few rows."""
    bad, least = faults(rows), None
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for gaps in itertools.product(inserts, repeat=len(rows) + 1):
        if sum(map(len, gaps)) > 4:
            continue
        for ops in itertools.product(["D", "K", "user", "assistant"], repeat=len(rows)):
            cost, audit, out = 0, "", []
            for gap, op, row, fault in zip(gaps, [*ops, None], [*rows, None], [*bad, None], strict=True):
                cost, audit, out = cost + 2 * len(gap), audit + "I" * len(gap), out + [(r, "") for r in gap]
                if op is None:
                    continue
                if op != "D" and fault in ("blank", "duplicate"):
                    break
                cost += {"D": 3, "K": 0}.get(op, 2) + (op != "D" and fault == "truncated")
                audit += op if op in "DK" else "R"
                if op != "D":
                    out.append((row[0] if op == "K" else op, row[1]))
            else:
                if ENDS.fullmatch("".join(r[:1] or "-" for r, _ in out)) and (least is None or (cost, audit) < least[:2]):
                    least = (cost, audit, tuple(out))
    return least


def expected(rows, damaged):
    """Contract columns of (conv, turn, role, text) rows, by conversation."""
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, r, x) for c, t, r, x in damaged if c == conv]
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, m[1], hashlib.md5(f"{len(m[1])}:{m[1]}{m[2]}".encode()).digest()))
        messages = [(r, x) for _, r, x in mine]
        bad, turns = faults(messages), [t for t, _, _ in mine if t is not None]
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(messages, messages[1:], strict=False))
        cost, audit, left = brute(messages)
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        lines = "\n".join(f"{r}:{x}" for r, x in left)
        out[conv] = (gaps, bad.count("blank"), bad.count("duplicate"), bad.count("truncated"), illegal, cost, audit, hashlib.sha256(lines.encode()).hexdigest())
    return out


def results(found):
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return {r.conv_id: tuple(r[n] for n in names) for r in found.collect()}


def some_rows(n, conv, rng):
    texts = ["Yes.", "no", " \t\n", "", "What?", "a\x0b!", "漢字。", "end. "]
    return [(conv, rng.randrange(2 * n) if rng.random() < 0.9 else None, rng.choice(["user", "assistant", "system", "user", "assistant", "tool", "", "uh"]),
             rng.choice(texts) + rng.choice(["", "", str(rng.randrange(9))])) for _ in range(n)]


def test_brute_force_agrees_with_all_edits():
    rng = random.Random(5)
    for _ in range(40):
        rows = [r[2:] for r in some_rows(rng.randrange(4), 0, rng)]
        assert brute(rows) == exhaustive(rows)


@pytest.mark.parametrize("block", [3, cr.BLOCK])
def test_against_brute_force(spark, block):
    rng = random.Random(block)
    rows = [r for conv in range(60) for r in some_rows(rng.randrange(1, 12), conv, rng)]
    rows += some_rows(150, 100, rng) + some_rows(20, None, rng) + [(101, 1, "user", "same.")] * 400
    rows += [(102, i, "user", f"{i}.") for i in range(300)] + [(103, i, "user", "x" * i) for i in range(40)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node int").repartition(3)
    assert results(cr.repair(df, block=block).conversations) == expected(rows, rows)


def test_messages(spark):
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "user", "So?"), (1, 3, "assistant", "x" * 300_000 + ".")]
    found = cr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert found.conversations.first().audit == "KDIKK"
    left = [(r.role, r.text[:4]) for r in found.messages.orderBy(*cr.ORDER).collect()]
    assert left == [("user", "Hi."), ("assistant", ""), ("user", "So?"), ("assistant", "xxxx")]


def test_damage_and_defined_cases(spark):
    import zlib

    rng = random.Random(9)
    rows = [r for conv in range(80) for r in some_rows(3, conv, rng)] + [(None, None, None, None), (None, 4, "user", None), (7, None, None, "a.b!c?")]
    rows += [(c, 0, "user", "x.") for c in range(200, 260)]
    damaged = []
    for c, t, r, x in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if d == 4 else r, "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x)
        damaged += [row] * (0 if d == 0 else 2 if d == 3 else 1)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = expected(rows, damaged)
    assert results(cr.repair(cr.damage(df), times_col="times").conversations) == want
    assert any(v == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for v in want.values())
    assert cr.repair(cr.damage(df.where("false")), times_col="times").conversations.collect() == []


def test_powers_and_cached_halves():
    for symbol in range(cr.MUST_GO + 1):
        step = cr.IDENTITY
        for n in range(1, 40):
            step = cr.times(step, cr.power(symbol, 0))
            assert cr.matrix_of([(symbol, n)]) == step
    audit, state = cr.audit_of([(2, 1), (cr.MUST_GO, 5000), (4, 1)], cr.START, cr.END)
    assert (audit, state) == ("K" + "D" * 5000 + "K", cr.A)
    long, _ = cr.audit_of([(2, 3000)], cr.START, cr.END)
    short, _ = cr.audit_of([(2, 1)] * 3000, cr.START, cr.END)
    assert long == short


def test_widest_gap(spark):
    rows = [(1, -(1 << 63), "user", "a."), (1, (1 << 63) - 1, "assistant", "b.")]
    assert cr.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).conversations.first().gaps == (1 << 63) - 1
