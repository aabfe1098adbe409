"""Cheapest repair of conversations whose roles must alternate: a run-length dynamic program in min-plus algebra.

A conversation's rows, by turn, become symbols: the role's class (system, user, assistant, other) and the row's
fault. Edits are Keep (0), Rerole to user or assistant (2), Delete (3; forced for a blank or duplicate row) and Insert of
an empty user or assistant message (2); a truncated row that stays costs 1. The roles' initials must come out as
``(s?(ua)+)?``, which four states recognise, so a row is a 4 x 4 min-plus matrix (inserts before it, then the row).

1. Rows that agree in turn, role and text are one entry with a count, combined before the shuffle: the first of
   them may stay, the others are duplicates. So a row with a million copies is one entry, and a run of its own.
2. Entries are range-partitioned by (conversation, turn, role, MD5 of role and text) and cut into blocks of at most ``BLOCK``
   entries of one conversation; a long conversation spans tasks. A block's equal consecutive symbols are collapsed into
   runs, and a run of n symbols advances by the cached binary powers of its matrix: log n products.
3. The blocks' matrices, of a conversation, give each block the costs to go after it, from the last to the first.
4. With the costs to go a block unrolls the ASCII-least cheapest edits for each state it may be entered in, run by run:
   2**k equal symbols are two halves of 2**(k-1), which a cache holds. An audit's prefix determines its state, so
   the least character that keeps the cost is the right one at each step.
5. A conversation's blocks are walked once from the empty state; kept rows get their texts by a join.

Texts cross one shuffle for the join and one for the order. A conversation's block summaries meet in one place: its audit
is one value of a row, below 2**31 characters, so there are at most 2**31 / ``BLOCK`` of them. The hash of a
repaired conversation is sequential by nature: one task streams its messages in order, an Arrow batch at a time.

Defined cases: null role or text is one space; null turns come first and do not count for gaps; rows of one turn go by
role, then by MD5 of both; a null conversation id is a conversation; an empty role has no initial, so that it must
be re-roled or deleted; a gap wider than a long is the largest long. Repeated rows are duplicates. Texts of any length
are taken whole, but a row's text must fit a batch. An empty table gives an empty result; other columns are dropped.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm.common import SQL_CRC_TABLE, landed, sql_crc32, table

# Costs of the edits, white space, and what ends a sentence.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
BLANK, STOPS = " \t\n\x0b\x0c\r", ".!?"

BLOCK = 1 << 14  # entries of a block
FAR = 1 << 50
LONGEST = (1 << 63) - 1

# States: nothing yet, after s, after u, after a. Symbols: 2 * class + truncated, or MUST_GO.
START, S, U, A = range(4)
MUST_GO = 8
AFTER = {START: U, S: U, U: A, A: U}  # where an inserted or re-roled message leads

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    columns = list(zip(*b, strict=True))
    return tuple(tuple(min(FAR, *(x + y for x, y in zip(row, col, strict=True))) for col in columns) for row in a)


def apply(a: Matrix, v: Vector) -> Vector:
    return tuple(min(FAR, *(x + y for x, y in zip(row, v, strict=True))) for row in a)


def _matrix(entries: dict[tuple[int, int], int]) -> Matrix:
    return tuple(tuple(entries.get((i, j), FAR) for j in range(4)) for i in range(4))


IDENTITY = _matrix({(i, i): 0 for i in range(4)})
_ONE = _matrix({(i, i): 0 for i in range(4)} | {(i, AFTER[i]): INSERT for i in range(4)})
INSERTS = times(_ONE, _ONE)  # a third insert in a row never pays
END = apply(INSERTS, (0, FAR, FAR, 0))


def choices(symbol: int) -> dict[int, list[tuple[str, int, int]]]:
    """By state, the edits (initial, state after, cost) of one row."""
    out = {i: [("D", i, DELETE)] for i in range(4)}
    if symbol != MUST_GO:
        kind, extra = divmod(symbol, 2)
        for i, to in AFTER.items():
            if (kind, i) == (0, START):
                out[i].append(("K", S, extra * TRUNCATED))
            if kind and kind + 1 == to:
                out[i].append(("K", to, extra * TRUNCATED))
            out[i].append(("R", to, REROLE + extra * TRUNCATED))
    return out


_CHOICES = [choices(symbol) for symbol in range(MUST_GO + 1)]


@functools.lru_cache(maxsize=1024)
def power(symbol: int, k: int) -> Matrix:
    """The transition of 2**k rows of one symbol."""
    if k:
        return times(power(symbol, k - 1), power(symbol, k - 1))
    row: dict[tuple[int, int], int] = {}
    for i, edits in _CHOICES[symbol].items():
        for _, to, cost in edits:
            row[i, to] = min(cost, row.get((i, to), FAR))
    return times(INSERTS, _matrix(row))


def _halves(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


def matrix_of(runs: list[tuple[int, int]]) -> Matrix:
    out = IDENTITY
    for symbol, n in runs:
        for k in _halves(n):
            out = times(out, power(symbol, k))
    return out


def _based(v: Vector) -> Vector:
    least = min(v)
    return tuple(min(FAR, x - least) for x in v)


def _one(symbol: int, state: int, after: Vector) -> tuple[str, int]:
    """The least cheapest edits of a row, with inserts before it, where going on costs ``after``."""
    out, go = "", apply(power(symbol, 0), after)
    while True:
        best = min([(c, to) for c, to, cost in _CHOICES[symbol][state] if cost + after[to] == go[state]], default=("~", state))
        if best[0] != "D" and INSERT + go[AFTER[state]] == go[state]:
            out, state = out + "I", AFTER[state]
        else:
            return out + best[0], best[1]


@functools.lru_cache(maxsize=1 << 14)
def _unrolled(symbol: int, k: int, state: int, after: Vector) -> tuple[str, int]:
    if not k:
        return _one(symbol, state, after)
    first, state = unroll(symbol, k - 1, state, apply(power(symbol, k - 1), after))
    second, state = unroll(symbol, k - 1, state, after)
    return first + second, state


def unroll(symbol: int, k: int, state: int, after: Vector) -> tuple[str, int]:
    """Edits of 2**k rows of one symbol and the state after them; long ones are not cached."""
    return (_unrolled if k <= 10 else _unrolled.__wrapped__)(symbol, k, state, _based(after))


def audit_of(runs: list[tuple[int, int]], state: int, tail: Vector) -> tuple[str, int]:
    """The least cheapest edits of runs entered in ``state``, where going on after them costs ``tail``."""
    steps, after = [], tail
    for symbol, n in reversed(runs):
        for k in _halves(n):
            steps.append((symbol, k, after))
            after = apply(power(symbol, k), after)
    out = []
    for symbol, k, after in reversed(steps):
        part, state = unroll(symbol, k, state, after)
        out.append(part)
    return "".join(out), state


def closing(state: int) -> str:
    """The inserts that end a conversation."""
    return {START: "", S: "II", U: "I", A: ""}[state]


def messages_of(audit: str, state: int, counts: list[int], symbols: list[int]) -> list[tuple[int, int, str | None]]:
    """(entry, or -1 for an inserted message; place; new role or None) of all that the edits leave."""
    out, entry, before, at, done = [], 0, 0, 0, 0  # instances before the entry; place in the audit; instances before it
    for found in re.finditer("[IKR]", audit):
        done += found.start() - at
        at = found.start() + 1
        if found[0] == "I":
            state = AFTER[state]
            out.append((-1, len(out), "user" if state == U else "assistant"))
            continue
        while before + counts[entry] <= done:
            before, entry = before + counts[entry], entry + 1
        if found[0] == "K":
            state = symbols[entry] // 2 + 1
            out.append((entry, len(out), None))
        else:
            state = AFTER[state]
            out.append((entry, len(out), "user" if state == U else "assistant"))
        done += 1
    return out


# -- Spark ---------------------------------------------------------------------------------------------------------

BLOCKS = ("pid int, seq int, conv {conv}, rows array<binary>, counts array<bigint>, symbols array<int>, run_symbols array<int>, run_lengths array<bigint>,"
          " matrix array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first_initial string, last_initial string,"
          " first_turn bigint, last_turn bigint, turns bigint")


def _blocks(schema: pa.Schema, size: int):
    """Sorted entries to blocks."""

    def block(conv, rows: list[dict], pid: int, seq: int) -> dict:
        out = dict.fromkeys(schema.names, 0) | {"pid": pid, "seq": seq, "conv": conv, "rows": [], "counts": [], "symbols": []}
        out |= dict.fromkeys(("first_initial", "last_initial", "first_turn", "last_turn"))
        runs: list[list[int]] = []
        for r in rows:
            n, symbol = r["times"], r["symbol"]
            if not n:
                continue
            out["rows"].append(r["row"])
            out["counts"].append(n)
            out["symbols"].append(symbol)
            out["blank" if r["blank"] else "duplicate"] += n if symbol == MUST_GO else n - 1
            out["truncated"] += symbol != MUST_GO and symbol % 2
            out["illegal"] += n - 1 + (out["last_initial"] is not None and out["last_initial"] + r["initial"] not in ("su", "ua", "au"))
            out["last_initial"] = r["initial"]
            if out["first_initial"] is None:
                out["first_initial"] = r["initial"]
            if r["turn"] is not None and r["turn"] != out["last_turn"]:
                out["turns"] += 1
                out["last_turn"] = r["turn"]
                if out["first_turn"] is None:
                    out["first_turn"] = r["turn"]
            for run in ([[MUST_GO, n]] if symbol == MUST_GO else [[symbol, 1], [MUST_GO, n - 1]]):
                if runs and runs[-1][0] == run[0]:
                    runs[-1][1] += run[1]
                elif run[1]:
                    runs.append(run)
        out["run_symbols"], out["run_lengths"] = [r[0] for r in runs], [r[1] for r in runs]
        out["matrix"] = [x for row in matrix_of(runs) for x in row]
        return out

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, seq, conv, rows, done = TaskContext.get().partitionId(), 0, None, [], []
        for batch in batches:
            for r in batch.to_pylist():
                if rows and (r["conv"] != conv or len(rows) == size):
                    done.append(block(conv, rows, pid, seq))
                    seq, rows = seq + 1, []
                conv = r["conv"]
                rows.append(r)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if rows:
            yield pa.RecordBatch.from_pylist([block(conv, rows, pid, seq)], schema)

    return emit


def _tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per conversation: its blocks' matrices to the costs to go after each block."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            tail = END
            for b in reversed(r["blocks"]):
                out.append({"pid": b["pid"], "seq": b["seq"], "tail": tail})
                tail = apply(tuple(tuple(b["matrix"][i : i + 4]) for i in range(0, 16, 4)), tail)
            out[-1]["cost"] = tail[START]  # of the first block
        yield pa.RecordBatch.from_pylist(out, pa.schema([("pid", pa.int32()), ("seq", pa.int32()), ("tail", pa.list_(pa.int64())), ("cost", pa.int64())]))


def _audits(schema: pa.Schema):
    """Blocks with their costs to go: the edits and the last state, by the state that a block is entered in."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                runs = list(zip(r.pop("run_symbols"), r.pop("run_lengths"), strict=True))
                entered = range(4) if r["cost"] is None else [START]
                found = [audit_of(runs, s, tuple(r["tail"])) for s in entered]
                out.append(r | {"audits": [f[0] for f in found], "exits": [f[1] for f in found]})
            yield pa.RecordBatch.from_pylist(out, schema)

    return emit


CONVERSATION = ("conv {conv}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string,"
                " walk array<struct<pid:int,seq:int,state:int,last:boolean>>")


def _walked(schema: pa.Schema):
    """Per conversation: its blocks, with their edits by state, to its result and the states in which they are entered."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                blocks, state, walk, audit = r["blocks"], START, [], []
                total = {c: sum(b[c] for b in blocks) for c in ("blank", "duplicate", "truncated", "illegal", "turns")}
                initial = turn = first = None
                for b in blocks:
                    if initial is not None and b["first_initial"] is not None:
                        total["illegal"] += initial + b["first_initial"] not in ("su", "ua", "au")
                    initial = b["last_initial"] if b["last_initial"] is not None else initial
                    if b["first_turn"] is not None:
                        total["turns"] -= b["first_turn"] == turn
                        turn = b["last_turn"]
                        first = b["first_turn"] if first is None else first
                    walk.append({"pid": b["pid"], "seq": b["seq"], "state": state, "last": b is blocks[-1]})
                    audit.append(b["audits"][state])
                    state = b["exits"][state]
                gaps = 0 if first is None else min(LONGEST, turn - first + 1 - total.pop("turns"))
                total.pop("turns", None)
                out.append(total | {"conv": r["conv"], "gaps": gaps, "cost": blocks[0]["cost"], "audit": "".join(audit) + closing(state), "walk": walk})
            yield pa.RecordBatch.from_pylist(out, schema)

    return emit


MESSAGES = "c_pid int, c_seq int, pid int, seq int, place int, row binary, new_role string"


def _left(schema: pa.Schema):
    """Walked blocks to the messages they leave; the last block's also end the conversation."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                audit = r["audits"][r["state"]] + (closing(r["exits"][r["state"]]) if r["last"] else "")
                for entry, place, role in messages_of(audit, r["state"], r["counts"], r["symbols"]):
                    out.append({c: r[c] for c in ("c_pid", "c_seq", "pid", "seq")} | {"place": place, "new_role": role, "row": None if entry < 0 else r["rows"][entry]})
            yield pa.RecordBatch.from_pylist(out, schema)

    return emit


ORDER = ["c_pid", "c_seq", "pid", "seq", "place"]


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages in order to the hash of each conversation's ``role:text`` lines."""
    schema = pa.schema([("c_pid", pa.int32()), ("c_seq", pa.int32()), ("repaired_sha256", pa.string())])
    at, digest, done = None, None, []
    for batch in batches:
        for r in batch.to_pylist():
            line = f"{r['role']}:{r['text']}".encode()
            if at != (r["c_pid"], r["c_seq"]):
                if at:
                    done.append({"c_pid": at[0], "c_seq": at[1], "repaired_sha256": digest.hexdigest()})
                at, digest = (r["c_pid"], r["c_seq"]), hashlib.sha256(line)
            else:
                digest.update(b"\n" + line)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)
            done = []
    if at:
        yield pa.RecordBatch.from_pylist([{"c_pid": at[0], "c_seq": at[1], "repaired_sha256": digest.hexdigest()}], schema)


def _arrow(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def _stripped(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANK))


class Repair(NamedTuple):
    conversations: DataFrame  # conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256
    messages: DataFrame  # conversation number (c_pid, c_seq), order (pid, seq, place), role, text


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
           times_col: str | None = None, block: int = BLOCK) -> Repair:
    """Repair every conversation of ``rows``. ``times_col``, if any, says how often a row is there; 0: the row only
    names its conversation."""
    spark = rows.sparkSession
    conv_type = rows.schema[conv_col].dataType.simpleString()
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    entries = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
                          (F.col(times_col) if times_col else F.lit(1)).cast("bigint").alias("times"))
    digest = F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), F.col("role"), F.col("text"))))
    named = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in ("conv", "turn")]
    entries = entries.withColumn("digest", digest).withColumn("row", F.unhex(F.md5(F.concat_ws("/", *named, F.hex("digest")))))

    # without texts: what a row is, and how often it is there
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    last = F.right(_stripped(F.col("text")), F.lit(1))
    facts = (entries.select("conv", "turn", "role", "digest", "row", "times", (last == "").alias("blank"),
                            (2 * kind + F.when(last.isin(*STOPS), 0).otherwise(1)).alias("symbol"))
             .groupBy("conv", "turn", "role", "digest", "row", "blank", "symbol").agg(F.sum("times").alias("times")))
    facts = landed(facts, "facts")
    seen = facts.where("times > 0").groupBy(F.col("conv").alias("c"), F.col("digest").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.col("turn").isNull()).alias("no_turn"), F.min("turn").alias("first_turn")).where("n > 1")
    seen = landed(seen, "seen")
    is_first = F.when(F.col("n").isNull(), True).when(F.col("no_turn"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first_turn"))
    marked = (facts.join(seen, F.col("conv").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
              .withColumn("symbol", F.when(F.col("blank") | ~is_first, MUST_GO).otherwise(F.col("symbol")))
              .select("conv", "turn", "role", "digest", "row", "symbol", "blank", "times", F.substring("role", 1, 1).alias("initial")))

    order = ["conv", "turn", "role", "digest"]
    ddl = BLOCKS.format(conv=conv_type)
    blocks = landed(marked.repartitionByRange(*order).sortWithinPartitions(*order).drop("role", "digest")
                    .mapInArrow(_blocks(_arrow(spark, ddl), block), ddl), "blocks")
    tails = (blocks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("pid", "seq", "matrix"))).alias("blocks")).select("blocks")
             .mapInArrow(_tails, "pid int, seq int, tail array<bigint>, cost bigint"))
    ready = blocks.drop("matrix").join(tails, ["pid", "seq"])
    gone = ("run_symbols", "run_lengths")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ready.schema if f.name not in gone) + ", audits array<string>, exits array<int>"
    unrolled = landed(ready.mapInArrow(_audits(_arrow(spark, ddl)), ddl), "unrolled")

    stats = ["pid", "seq", "cost", "blank", "duplicate", "truncated", "illegal", "first_initial", "last_initial", "first_turn", "last_turn", "turns", "audits", "exits"]
    ddl = CONVERSATION.format(conv=conv_type)
    walked = landed(unrolled.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*stats))).alias("blocks"))
                    .mapInArrow(_walked(_arrow(spark, ddl)), ddl), "walked")
    place = walked.select(F.col("walk")[0]["pid"].alias("c_pid"), F.col("walk")[0]["seq"].alias("c_seq"), F.explode("walk").alias("w")).select("c_pid", "c_seq", "w.*")
    left = (unrolled.select("pid", "seq", "rows", "counts", "symbols", "audits", "exits").join(place, ["pid", "seq"])
            .mapInArrow(_left(_arrow(spark, MESSAGES)), MESSAGES))
    left = landed(left, "left")
    texts = entries.where("times > 0").groupBy("row").agg(F.first(F.struct("role", "text")).alias("t")).select("row", "t.*")
    kept = left.where("row is not null").join(texts, "row").select(*ORDER, F.coalesce("new_role", "role").alias("role"), "text")
    messages = kept.unionByName(left.where("row is null").select(*ORDER, F.col("new_role").alias("role"), F.lit("").alias("text")))

    hashes = (messages.repartition("c_pid", "c_seq").sortWithinPartitions(*ORDER).mapInArrow(_hashes, "c_pid int, c_seq int, repaired_sha256 string"))
    found = (walked.withColumn("c_pid", F.col("walk")[0]["pid"]).withColumn("c_seq", F.col("walk")[0]["seq"]).drop("walk")
             .join(hashes, ["c_pid", "c_seq"], "left").drop("c_pid", "c_seq").withColumnRenamed("conv", conv_col)
             .withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest()))))
    return Repair(found, messages)


def damage(rows: DataFrame) -> DataFrame:
    """The contract's damage to conv_id, turn, role, text, by CRC-32 of ``conv_id:turn``; ``times`` is how often a row is there."""
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    d = F.crc32(F.concat(named[0], F.lit(":"), named[1])) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select("conv_id", "turn", F.when(d == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(d == 1, "").when(d == 2, F.translate(text, STOPS, "")).otherwise(text).alias("text"),
                       F.when(d == 0, 0).when(d == 3, 2).otherwise(1).alias("times"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")), times_col="times").conversations


# Row by row: of each state the cheapest edits, the least on ties, with the text they leave.
ORACLE = rf"""
WITH RECURSIVE crc AS (SELECT {SQL_CRC_TABLE} AS t),
c AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {sql_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS d FROM conversations, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN d = 1 THEN '' WHEN d = 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS again
        FROM c WHERE d <> 0),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(length(role) || ':' || role || text), again) AS i FROM damaged),
faults AS (SELECT *, rtrim(text, E' \t\n\x0B\x0C\r') AS r, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS seen FROM placed),
marked AS (SELECT *, r = '' AS blank, r <> '' AND seen AS duplicate, r <> '' AND NOT seen AND right(r, 1) NOT IN ('.', '!', '?') AS truncated,
        left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM faults),
ways(state, ins, mid, paid, lines) AS (VALUES
    (0, '', 0, 0, []), (0, 'I', 2, 2, ['user:']), (0, 'II', 3, 4, ['user:', 'assistant:']),
    (1, '', 1, 0, []), (1, 'I', 2, 2, ['user:']), (1, 'II', 3, 4, ['user:', 'assistant:']),
    (2, '', 2, 0, []), (2, 'I', 3, 2, ['assistant:']), (3, '', 3, 0, []), (3, 'I', 2, 2, ['user:'])),
edits(mid, op, after, price, role, initial) AS (VALUES
    (0, 'D', 0, 3, '', ''), (1, 'D', 1, 3, '', ''), (2, 'D', 2, 3, '', ''), (3, 'D', 3, 3, '', ''),
    (0, 'R', 2, 2, 'user', ''), (1, 'R', 2, 2, 'user', ''), (3, 'R', 2, 2, 'user', ''), (2, 'R', 3, 2, 'assistant', ''),
    (0, 'K', 1, 0, '', 's'), (0, 'K', 2, 0, '', 'u'), (1, 'K', 2, 0, '', 'u'), (3, 'K', 2, 0, '', 'u'), (2, 'K', 3, 0, '', 'a')),
dp AS (SELECT conv_id, 0 AS i, 0 AS state, 0 AS cost, '' AS audit, CAST([] AS VARCHAR[]) AS lines FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, i, after, cost, audit, lines FROM (
        SELECT p.conv_id, m.i, e.after, p.cost + w.paid + e.price + CASE WHEN e.op <> 'D' AND m.truncated THEN 1 ELSE 0 END AS cost, p.audit || w.ins || e.op AS audit,
            p.lines || w.lines || CASE e.op WHEN 'D' THEN [] WHEN 'K' THEN [m.role || ':' || m.text] ELSE [e.role || ':' || m.text] END AS lines
        FROM dp p JOIN marked m ON m.conv_id IS NOT DISTINCT FROM p.conv_id AND m.i = p.i + 1 JOIN ways w USING (state) JOIN edits e ON e.mid = w.mid
        WHERE e.op = 'D' OR NOT (m.blank OR m.duplicate) AND (e.op = 'R' OR e.initial = m.initial))
    QUALIFY row_number() OVER (PARTITION BY conv_id, i, after ORDER BY cost, audit) = 1),
ends AS (SELECT p.conv_id, p.i, cost + w.paid AS cost, audit || w.ins AS audit, p.lines || w.lines AS lines FROM dp p JOIN ways w USING (state) WHERE w.mid IN (0, 3)
    QUALIFY row_number() OVER (PARTITION BY p.conv_id ORDER BY p.i DESC, cost + w.paid, audit || w.ins) = 1),
counted AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank, count_if(duplicate) AS duplicate,
        count_if(truncated) AS truncated, count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank, CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate,
    CAST(coalesce(truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(cost AS BIGINT) AS cost, audit,
    sha256(array_to_string(lines, chr(10))) AS repaired_sha256
FROM ends e LEFT JOIN counted k ON k.conv_id IS NOT DISTINCT FROM e.conv_id
"""
