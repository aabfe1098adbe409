"""Removal of repeated byte strings: a depth-limited radix sort of all suffixes, most significant digit first.

Two suffixes are told apart only within their first ``window`` bytes, so suffixes that stay in one bucket to that
depth are exactly the repeated windows. The digits of a suffix are parts of its first ``window`` bytes, taken in
an order that empties buckets soonest; an order of digits does not change which suffixes end up equal:

1. The anchor, the window's smallest 16-byte gram by hash, leftmost on ties. Equal windows have equal anchors
   at equal places. Neighbouring suffixes share their anchor, so that one row, a segment, stands for a run of
   them (some 190 on average); a bucket with one segment is done, and most of a corpus leaves here.
2. In buckets with several segments, the bytes common to all windows of a cell of 32 neighbouring suffixes.
3. In buckets still mixed, the whole window, one suffix at a time.

On each level, segments or cells that agree in all their bytes are one entry with a count: its suffixes are repeated
and need no deeper pass, and one of them stands for all in the passes below. So a passage with a million copies
costs one entry, and no group is gathered in a task: every pass is counts by key, combined before the shuffle,
and a join back that may split a hot key. Digits travel as fingerprints of up to 64 bits, whole cells and windows as 122 bits.

Only documents that still have open segments after the first pass are joined with their text again. What a pass has
shuffled, and what no later pass reads, is deleted when the pass has been written.

Null or empty texts, and texts shorter than the window, lose nothing; repeated rows count as elsewhere, so both
lose all. Texts of any length are scanned in overlapping pieces. Rows with null or equal ids are told apart by
their text. An empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paddock.llm.common import discard, join_by_key, landed, row_key, shuffles_dropped, table

GRAM = 16  # bytes of an anchor
CELL = 32  # suffixes of a cell
PIECE = 1 << 19  # bytes scanned at once
BATCH = 1 << 16  # rows of an Arrow batch made here
BLOCK = 1 << 14  # fingerprints computed at once, small enough for a processor's cache

KEY = [T.StructField("key_id", T.LongType()), T.StructField("key_hash", T.LongType())]


PRIME = np.uint64((1 << 61) - 1)


def _reduced(x: np.ndarray) -> np.ndarray:
    x = (x & PRIME) + (x >> np.uint64(61))
    return np.minimum(x, x - PRIME)  # below the prime, the difference wraps


def _folded(x: np.ndarray) -> np.ndarray:
    """``x * 2**31`` modulo the prime, not fully reduced, for ``x`` below 2**62."""
    return (x >> np.uint64(30)) + ((x & np.uint64((1 << 30) - 1)) << np.uint64(31))


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a * b`` modulo the prime, from halves of 30 and 31 bits, so that nothing overflows."""
    half, low = np.uint64(31), np.uint64((1 << 31) - 1)
    a1, a0, b1, b0 = a >> half, a & low, b >> half, b & low
    return _reduced(np.uint64(2) * (a1 * b1) + _folded(a1 * b0 + a0 * b1) + a0 * b0)


class Hasher:
    """Polynomial fingerprints, modulo the prime 2**61 - 1, of any substring of a buffer of less than 2**20 bytes, in two
    independent bases. (Modulo 2**64, structured texts such as Thue-Morse strings agree in any base.)"""

    def __init__(self, length: int):
        rng = np.random.default_rng(20240229)
        self.powers, self.inverses = [], []
        for _ in range(2):
            base = int(rng.integers(1 << 60, (1 << 61) - 1))
            powers = self._powers(base, length)
            self.powers.append((powers & np.uint64((1 << 31) - 1), powers >> np.uint64(31)))
            self.inverses.append(self._powers(pow(base, -1, int(PRIME)), length))

    @staticmethod
    def _powers(base: int, length: int) -> np.ndarray:
        out = np.ones(1, dtype=np.uint64)
        while len(out) < length:
            out = np.concatenate((out, _product(out, np.uint64(pow(base, len(out), int(PRIME))))))
        return out[:length]

    def sums(self, data: np.ndarray, j: int) -> np.ndarray:
        out = np.zeros(len(data) + 1, dtype=np.uint64)
        low = high = out[:1]
        for i in range(0, len(data), BLOCK):
            letters = data[i : i + BLOCK].astype(np.uint64) + np.uint64(1)
            low, high = (np.cumsum(letters * half[i : i + len(letters)]) + last[-1] for half, last in zip(self.powers[j], (low, high), strict=True))
            out[i + 1 : i + 1 + BLOCK] = _reduced(low + _folded(high))
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray, j: int) -> np.ndarray:
        out = np.empty(len(start), dtype=np.uint64)
        for i in range(0, len(start), BLOCK):
            s, e = start[i : i + BLOCK], end[i : i + BLOCK]
            out[i : i + BLOCK] = _mixed(_product(_reduced(sums[e] + (PRIME - sums[s])), self.inverses[j][s]))
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@functools.lru_cache(maxsize=1)
def _hasher() -> Hasher:
    return Hasher(PIECE + 8192)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hashes of all 16-byte grams, from their two halves as integers; grams that collide only share a bucket."""
    halves = np.lib.stride_tricks.sliding_window_view(data, GRAM // 2).view("<u8")[:, 0]
    return _mixed(halves[: -GRAM // 2] * np.uint64(0x9E3779B97F4A7C15) + halves[GRAM // 2 :])


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring keys: block-wise running minima from both sides."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def segments(data: np.ndarray, ends: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Runs of suffixes that share an anchor, in a buffer of texts that end at ``ends``: first suffix, number of
    suffixes, anchor's place, the anchor's fingerprint, and two of all bytes that the run's windows cover."""
    h, n = _hasher(), len(data)
    none = np.zeros(0, dtype=np.int64)
    if n < window:
        return {"lo": none, "n": none, "at": none, "digit": none, "f1": none, "f2": none}
    grams = gram_hashes(data)
    order = (grams & ~np.uint64((1 << 31) - 1)) | np.arange(len(grams), dtype=np.uint64)
    anchors = (window_minima(order, window - GRAM + 1) & np.uint64((1 << 31) - 1)).astype(np.int64)
    fits = np.ones(n - window + 1, dtype=bool)  # windows inside one text
    for e in ends[:-1].tolist():
        fits[max(0, e - window + 1) : e] = False
    starts = np.flatnonzero(fits)
    if not len(starts):
        return {"lo": none, "n": none, "at": none, "digit": none, "f1": none, "f2": none}
    at = anchors[starts]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1))))
    lo, count, at = starts[new], np.diff(np.append(new, len(starts))), at[new]
    end = lo + count - 1 + window
    return {"lo": lo, "n": count, "at": at, "digit": grams[at].view(np.int64),
            "f1": h.of(h.sums(data, 0), lo, end, 0).view(np.int64), "f2": h.of(h.sums(data, 1), lo, end, 1).view(np.int64)}


def cells(data: np.ndarray, base: np.ndarray, n: np.ndarray, at: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """Cut segments, whose bytes start at ``base`` in a buffer and whose anchors are at ``at`` in it, into cells."""
    h = _hasher()
    s1, s2 = h.sums(data, 0), h.sums(data, 1)
    first, last = (at - base - n + 1) // CELL, (at - base) // CELL
    per = last - first + 1
    of = np.repeat(np.arange(len(base)), per)
    c = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per) + first[of]
    core = at[of] - CELL * c
    lo, hi = np.maximum(base[of], core - CELL + 1), np.minimum(base[of] + n[of] - 1, core)
    digit = h.of(s1, core, core + window - CELL + 1, 0) + c.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return {"of": of, "lo": lo - base[of], "n": hi - lo + 1, "digit": digit.view(np.int64),
            "f1": h.of(s1, lo, hi + window, 0).view(np.int64), "f2": h.of(s2, lo, hi + window, 1).view(np.int64)}


def windows(data: np.ndarray, base: np.ndarray, n: np.ndarray, window: int) -> dict[str, np.ndarray]:
    """The single windows of cells whose bytes start at ``base``."""
    h = _hasher()
    of = np.repeat(np.arange(len(base)), n)
    lo = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = base[of] + lo
    f1 = h.of(h.sums(data, 0), start, start + window, 0).view(np.int64)
    return {"of": of, "lo": lo, "n": np.ones(len(of), dtype=np.int64), "digit": f1, "f1": f1,
            "f2": h.of(h.sums(data, 1), start, start + window, 1).view(np.int64)}


ENTRY = T.StructType([*KEY, T.StructField("lo", T.LongType()), T.StructField("n", T.IntegerType()),
                      T.StructField("at", T.LongType()), T.StructField("known", T.BooleanType()),
                      T.StructField("digit", T.LongType()), T.StructField("f1", T.LongType()),
                      T.StructField("f2", T.LongType())])


def _schema() -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(ENTRY)


def _batches(ids, hashes, lo, n, at, known, found) -> Iterator[pa.RecordBatch]:
    schema = _schema()
    columns = [ids, hashes, lo, n, at, known, found["digit"], found["f1"], found["f2"]]
    for i in range(0, len(lo), BATCH):
        yield pa.RecordBatch.from_arrays([pa.array(c[i : i + BATCH], f.type, from_pandas=True) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _spread(values: list, of: np.ndarray) -> pa.Array:
    return pa.array(values, pa.int64()).take(pa.array(of, pa.int64()))


def _scan(window: int):
    """Pass 1: documents to segments."""

    def emit(pieces: list[tuple]) -> Iterator[pa.RecordBatch]:
        data = np.frombuffer(b"".join(p[3] for p in pieces), dtype=np.uint8)
        sizes = np.array([len(p[3]) for p in pieces])
        ends = np.cumsum(sizes)
        found = segments(data, ends, window)
        of = np.searchsorted(ends, found["lo"], side="right")
        shift = np.array([p[2] for p in pieces]) - (ends - sizes)
        yield from _batches(_spread([p[0] for p in pieces], of), _spread([p[1] for p in pieces], of), found["lo"] + shift[of],
                            found["n"], found["at"] + shift[of], np.zeros(len(of), dtype=bool), found)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                key_id, key_hash, text = (batch.column(c)[i].as_py() for c in ("key_id", "key_hash", "text"))
                raw = text.encode() if text else b""
                for at in range(0, max(0, len(raw) - window + 1), PIECE - window + 1):
                    piece = raw[at : at + PIECE]
                    if size + len(piece) > PIECE and pieces:
                        yield from emit(pieces)
                        pieces, size = [], 0
                    pieces.append((key_id, key_hash, at, piece))
                    size += len(piece)
        if pieces:
            yield from emit(pieces)

    return scan


def _deeper(window: int, single: bool):
    """Passes 2 and 3: documents with their open entries to cells, or to windows if ``single``."""

    def emit(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        ids, hashes, lo, n, at, known, raw = zip(*parts, strict=True)
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        sizes = np.array([len(r) for r in raw])
        base, lo, n, at = np.cumsum(sizes) - sizes, np.array(lo), np.array(n), np.array(at)
        found = windows(data, base, n, window) if single else cells(data, base, n, base + at - lo, window)
        of = found["of"]
        yield from _batches(_spread(ids, of), _spread(hashes, of), lo[of] + found["lo"], found["n"], at[of], np.array(known)[of], found)

    def deepen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                key_id, key_hash, text, entries = (batch.column(c)[i].as_py() for c in ("key_id", "key_hash", "text", "open"))
                raw = text.encode()
                for e in entries:
                    piece = raw[e["lo"] : e["lo"] + e["n"] - 1 + window]
                    if size + len(piece) > PIECE:
                        yield from emit(parts)
                        parts, size = [], 0
                    parts.append((key_id, key_hash, e["lo"], e["n"], e["at"], e["known"], piece))
                    size += len(piece)
        if parts:
            yield from emit(parts)

    return deepen


FULL = ["digit", "f1", "f2"]
SAME = ["key_id", "key_hash"]


def _in_shared_buckets(entries: DataFrame) -> DataFrame:
    """Entries, landed, whose digit another entry has too; the others' files go."""
    digits = landed(entries.groupBy("digit").agg(F.count("*").alias("c")).where("c > 1").select("digit"), "digits")
    shared = landed(entries.join(digits, "digit", "left_semi"), "shared")
    discard(entries)
    discard(digits)
    return shared


def _decided(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of repeated entries, and of each different entry in a mixed bucket one that goes on."""
    counted = landed(entries.groupBy(*FULL).agg(
        F.sum(F.when(F.col("known"), 2).otherwise(1)).alias("c"),
        F.min(F.struct(*SAME, "lo", "n", "at")).alias("one")), "counted")
    repeated = counted.where("c > 1").select(*FULL)
    spans = entries.where("not known").join(repeated, FULL, "left_semi").select(*SAME, "lo", "n")
    mixed = landed(counted.groupBy("digit").agg(F.count("*").alias("kinds")).where("kinds > 1").select("digit"), "mixed")
    going = counted.join(mixed, "digit", "left_semi").select("one.*", (F.col("c") > 1).alias("known"))
    return spans, going


def _with_open(texts: DataFrame, going: DataFrame) -> DataFrame:
    """Documents that have entries that go on, with them; a document has at most one for each of its bytes."""
    lists = going.groupBy(*SAME).agg(F.collect_list(F.struct("lo", "n", "at", "known")).alias("open"))
    return join_by_key(texts.select(*SAME, "text"), lists, "inner")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 400) -> DataFrame:
    """Per row key (key_id, key_hash), the byte spans (s, e) to remove; spans may overlap."""
    if window < 2 * CELL + GRAM:
        raise ValueError(f"window must be at least {2 * CELL + GRAM} bytes")
    with shuffles_dropped(docs.sparkSession):
        return _spans_by_pass(docs.select(*row_key(id_col, text_col), F.col(text_col).alias("text")), window)


def _spans_by_pass(texts: DataFrame, window: int) -> DataFrame:
    found = landed(texts.where(F.octet_length("text") >= window).mapInArrow(_scan(window), ENTRY), "segments")
    spans, going = _decided(_in_shared_buckets(found))
    open_docs = landed(_with_open(texts, going), "open", compression="zstd")
    found = _in_shared_buckets(landed(open_docs.mapInArrow(_deeper(window, single=False), ENTRY), "cells"))
    more, going = _decided(found)
    found = landed(_with_open(open_docs, going).mapInArrow(_deeper(window, single=True), ENTRY), "windows")
    discard(open_docs)
    repeated = landed(found.groupBy("f1", "f2").agg(F.sum(F.when(F.col("known"), 2).otherwise(1)).alias("c"))
                      .where("c > 1").select("f1", "f2"), "repeated")
    last = found.where("not known").join(repeated, ["f1", "f2"], "left_semi").select(*SAME, "lo", "n")
    return (spans.unionByName(more).unionByName(last)
            .select(*SAME, F.col("lo").alias("s"), (F.col("lo") + F.col("n") - 1 + window).alias("e")))


def _cut(text_col: str, schema: pa.Schema):
    """Adds the maximal removed runs and the kept bytes to rows that have their spans."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs, kept = [], []
            for text, spans in zip(batch.column(text_col), batch.column("spans"), strict=True):
                raw, out, merged, at = (text.as_py() or "").encode(), [], [], 0
                for s in sorted((x["s"], x["e"]) for x in spans.as_py() or ()):
                    if merged and s[0] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s[1])
                    else:
                        merged.append([*s])
                for s, e in merged:
                    out.append(raw[at:s])
                    at = e
                runs.append([{"s": s, "e": e} for s, e in merged])
                kept.append(b"".join([*out, raw[at:]]))
            columns = [batch.column(f.name) for f in schema if f.name not in ("removed", "kept")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(runs, schema.field("removed").type), pa.array(kept, pa.binary())], schema=schema)

    return cut


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 400) -> DataFrame:
    """``docs`` with ``removed`` (maximal removed byte runs, array of s and e) and ``kept`` (the remaining bytes)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    docs = docs.drop("removed", "kept", "spans", *SAME)
    lists = (repeated_spans(docs, id_col, text_col, window).groupBy(*SAME)
             .agg(F.collect_set(F.struct("s", "e")).alias("spans")))
    rows = join_by_key(docs.select("*", *row_key(id_col, text_col)), lists).drop(*SAME)
    out = T.StructType([*docs.schema.fields, T.StructField("removed", T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))),
                        T.StructField("kept", T.BinaryType())])
    return rows.mapInArrow(_cut(text_col, to_arrow_schema(out)), out)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return out.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
