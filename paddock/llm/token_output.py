"""Token ids in bit-plane-shuffled, compressed chunks, and the reader of that format.

Documents are range-partitioned and sorted by id (null ids first; rows of one id by text hash), encoded in
that order, and each partition's id stream, an end id after each document, is cut into blocks of a fixed number
of ids. A block of unsigned 32-bit ids is transposed into byte planes (4) or bit planes (32), so that the almost
constant high planes shrink to nothing, and every plane is compressed with zstandard on its own.

A file set is a folder with two tables. ``chunks`` has one row per block: shard, block, first_id (ids before it in
the shard), n_ids, planes, and the chunk index of the document pieces it holds (ordinal, doc_id, offset of the piece
in its document, length, and the document's whole length where the piece ends it). ``shards`` has the number of ids
before each shard. Spark's own committer writes them, so that a lost executor leaves no half-written chunk. A reader
needs only the chunks that it wants: any chunk decodes alone, and a document that crosses chunks is read in pieces.

Null or empty text is a document of the end id only. Repeated ids and rows are documents of their own. An empty
table gives empty files. Further columns are ignored.
"""

from __future__ import annotations

import functools
import zlib
from array import array
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import tokenizing as tk
from paddock.llm.common import landed, table
from paddock.session import scratch_dir

BLOCK_IDS = 1 << 16

#: Longer units are encoded each time instead of being kept.
MAX_UNIT_CHARS = 64

#: New units that are encoded in one call.
RUN_UNITS = 1 << 12

CHUNKS = ("shard int, block int, first_id long, n_ids int, planes array<binary>, ordinals array<long>, "
          "doc_ids array<long>, offsets array<long>, lengths array<int>, totals array<long>")

# White space (Unicode White_Space) before a space: only then may a split at single spaces cut a pre-token.
_DOUBLE = regex.compile(r"\s ")
_UNITS = regex.compile(r"\s*\S+|\s+")


class UnitEncoder:
    """Encodes texts as runs of little-endian 32-bit ids, unit by unit.

    A unit starts at white space that follows other characters. No pre-token crosses such a place, so the
    ids of a text are the ids of its units in turn; units met before come from the worker's cache."""

    def __init__(self, path: str, cache_entries: int):
        tk.check_byte_level(path)
        tokenizer = tk.load(path)
        self.encode = tokenizer.encode_batch_fast
        self.spaced = np.zeros(max(tokenizer.get_vocab().values()) + 1, dtype=bool)  # tokens that begin with a space
        self.spaced[[i for t, i in tokenizer.get_vocab(with_added_tokens=False).items() if t[0] == "\u0120"]] = True
        self.specials = tk.special_strings(path)
        self.known: dict[str, bytes] = {}
        self.room = cache_entries

    def units(self, plain: str) -> list[str]:
        """Units in order: the first as it is, a later one without the single space before it, or, where white
        space runs or zero characters occur, after a zero character that marks it as spelt out."""
        if not plain:
            return []
        if "\0" in plain or plain[0] == " " or _DOUBLE.search(plain):
            found = _UNITS.findall(plain)
            return [found[0], *("\0" + u for u in found[1:])]
        return plain.split(" ")

    def learn(self, units: list[str]) -> None:
        """Encode units as one text and cut it where a token begins with a space: each unit has just one, at its front.
        Another number of such tokens than of units means that one of them crosses units; then nothing is kept."""
        ids = np.array(self.encode([" " + " ".join(units)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = (4 * np.flatnonzero(self.spaced[ids])).tolist()
        if len(cuts) == len(units):
            raw = ids.tobytes()
            self.known.update(zip(units, map(raw.__getitem__, map(slice, cuts, [*cuts[1:], len(raw)])), strict=True))

    def ids(self, texts: list[str | None], end: bytes) -> list[bytes]:
        known, per_text = self.known, []
        for text in texts:
            units: list[str] = []
            for plain, special in tk.by_specials(text or "", self.specials):
                if special:
                    units.append("\0" + plain)  # alone it encodes to its id
                    continue
                for part in tk.slices(plain):
                    found = self.units(part)
                    if found:
                        found[0] = "\0" + found[0]
                    units += found
            per_text.append(units)
        order = list(set().union(*per_text).difference(known))
        runs = [u for u in order if u and u[0] != "\0" and not u[-1].isspace()]
        for at in range(0, len(runs), RUN_UNITS):
            self.learn(runs[at : at + RUN_UNITS])
        alone = [u for u in order if u not in known]
        for u, e in zip(alone, self.encode([u[1:] if u[:1] == "\0" else " " + u for u in alone], add_special_tokens=False), strict=True):
            known[u] = array("I", e.ids).tobytes()
        get = known.__getitem__
        out = [b"".join(map(get, units)) + end for units in per_text]
        for u in order if len(known) > self.room else [u for u in order if len(u) > MAX_UNIT_CHARS]:
            del known[u]
        return out


@functools.lru_cache(maxsize=2)
def _encoder(path: str, cache_entries: int) -> UnitEncoder:
    return UnitEncoder(path, cache_entries)


def shuffle_planes(ids: np.ndarray, bits: bool) -> list[bytes]:
    """Transpose little-endian 32-bit ids into 4 byte planes or 32 bit planes."""
    rows = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if bits:
        return [p.tobytes() for p in np.packbits(np.unpackbits(rows, axis=1, bitorder="little").T, axis=1)]
    return [p.tobytes() for p in rows.T]


def unshuffle_planes(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of a block from its decompressed planes."""
    parts = np.array([np.frombuffer(p, dtype=np.uint8) for p in planes]).reshape(len(planes), -1)
    if len(planes) == 32:
        parts = np.packbits(np.unpackbits(parts, axis=1, count=n).T, axis=1, bitorder="little").T
    return np.ascontiguousarray(parts.T).view("<u4").reshape(-1)


class _BlockWriter:
    """Collects one shard's id stream and gives out chunk rows of ``block_ids`` ids."""

    def __init__(self, shard: int, block_ids: int, bits: bool, level: int):
        self.shard, self.size, self.bits = shard, 4 * block_ids, bits
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.block = self.first = self.ordinal = 0
        self.data, self.index = bytearray(), []

    def add(self, doc_id: int | None, ids: bytes) -> Iterator[dict]:
        at, view = 0, memoryview(ids)
        while at < len(ids):
            take = min(len(ids) - at, self.size - len(self.data))
            self.data += view[at : at + take]
            done = at + take == len(ids)
            self.index.append((self.ordinal, doc_id, at // 4, take // 4, len(ids) // 4 if done else None))
            at += take
            if len(self.data) == self.size:
                yield self.flush()
        self.ordinal += 1

    def flush(self) -> dict:
        ids = np.frombuffer(bytes(self.data), dtype="<u4")
        ordinals, doc_ids, offsets, lengths, totals = zip(*self.index, strict=True)
        row = {"shard": self.shard, "block": self.block, "first_id": self.first, "n_ids": len(ids),
               "planes": [self.compress(p) for p in shuffle_planes(ids, self.bits)], "ordinals": ordinals,
               "doc_ids": doc_ids, "offsets": offsets, "lengths": lengths, "totals": totals}
        self.block, self.first, self.data, self.index = self.block + 1, self.first + len(ids), bytearray(), []
        return row


def _arrow(ddl_schema) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(ddl_schema)


def write_tokens(docs: DataFrame, tokenizer_path: str, end_id: int, path: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", block_ids: int = BLOCK_IDS, bits: bool = False, level: int = 3,
                 cache_entries: int = 700_000) -> str:
    """Write the file set of ``docs`` and return its folder (a fresh one under the checkpoint folder by default)."""
    from pyspark.sql.types import _parse_datatype_string

    spark = docs.sparkSession
    path = path or scratch_dir(spark, "tokens")
    schema = _arrow(_parse_datatype_string(CHUNKS))
    ordered = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                           F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"))
               .repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, end = _encoder(tokenizer_path, cache_entries), np.uint32(end_id).tobytes()
        out = _BlockWriter(TaskContext.get().partitionId(), block_ids, bits, level)
        rows: list[dict] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column("text").to_pylist()
                for doc_id, ids in zip(part.column("doc_id").to_pylist(), encoder.ids(texts, end), strict=True):
                    rows += out.add(doc_id, ids)
                if len(rows) >= 16:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)
                    rows = []
        if out.data:
            rows.append(out.flush())
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    ordered.mapInArrow(encode, CHUNKS).write.option("compression", "none").parquet(f"{path}/chunks")
    # one row per shard: as many as write tasks, whatever the input
    sizes = sorted(map(tuple, spark.read.parquet(f"{path}/chunks").groupBy("shard").agg(F.sum("n_ids")).collect()))
    before = [0, *accumulate(n for _, n in sizes)]
    rows = [(s, b, n) for (s, n), b in zip(sizes, before, strict=False)]
    spark.createDataFrame(rows, "shard int, ids_before long, n_ids long").coalesce(1).write.parquet(f"{path}/shards")
    return path


def decoded(chunk: dict) -> np.ndarray:
    unpack = zstandard.ZstdDecompressor().decompress
    return unshuffle_planes([unpack(p) for p in chunk["planes"]], chunk["n_ids"])


PIECES = "shard int, ordinal long, doc_id long, offset long, length int, total long, first_id long, "


def read_pieces(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """One row per piece of a document in a chunk, with its ids (binary, 32-bit little-endian), or with ``digest``
    their crc32 instead; ``start`` counts the ids before the piece's document over all shards."""
    from pyspark.sql.types import _parse_datatype_string

    ddl = PIECES + ("crc long" if digest else "ids binary")
    schema = _arrow(_parse_datatype_string(ddl))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                c = batch.slice(i, 1).to_pylist()[0]
                data, at, rows = decoded(c).tobytes(), 0, []
                for ordinal, doc_id, offset, length, total in zip(
                        c["ordinals"], c["doc_ids"], c["offsets"], c["lengths"], c["totals"], strict=True):
                    ids = data[at : at + 4 * length]
                    rows.append((c["shard"], ordinal, doc_id, offset, length, total, c["first_id"] + at // 4,
                                 zlib.crc32(ids) if digest else ids))
                    at += 4 * length
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema, strict=True)], schema=schema)

    shards = spark.read.parquet(f"{path}/shards").select("shard", "ids_before")
    return (spark.read.parquet(f"{path}/chunks").drop("block").mapInArrow(decode, ddl)
            .join(F.broadcast(shards), "shard")  # one row per write task
            .withColumn("start", F.col("ids_before") + F.col("first_id") - F.col("offset"))
            .drop("ids_before", "first_id"))


def _times(matrix: list[int], vector: int) -> int:
    out = i = 0
    while vector:
        if vector & 1:
            out ^= matrix[i]
        vector >>= 1
        i += 1
    return out


@functools.lru_cache(maxsize=64)
def _zeros(power: int) -> list[int]:
    """The GF(2) matrix that appends 2**power zero bytes to what a crc32 has read."""
    if power == 0:
        m = [0xEDB88320, *(1 << k for k in range(31))]  # one zero bit
        for _ in range(3):
            m = [_times(m, c) for c in m]
        return m
    half = _zeros(power - 1)
    return [_times(half, c) for c in half]


def crc32_joined(first: int, second: int, second_bytes: int) -> int:
    """The crc32 of two byte strings in a row from the crc32 of each."""
    power = 0
    while second_bytes:
        if second_bytes & 1:
            first = _times(_zeros(power), first)
        second_bytes >>= 1
        power += 1
    return first ^ second


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of a file set: doc_id, start, n_tokens, ids_crc32, read back from its chunks."""
    pieces = landed(read_pieces(spark, path, digest=True), "pieces")
    whole = pieces.where((F.col("offset") == 0) & F.col("total").isNotNull())

    @F.pandas_udf("long")
    def joined(parts: pd.Series) -> pd.Series:
        def one(rows):
            crc = 0
            for r in rows:
                crc = crc32_joined(crc, r["crc"], 4 * r["length"])
            return crc

        return parts.map(one)

    # pieces of documents that cross chunks: a document has one for every block_ids of its ids
    crossing = (pieces.where((F.col("offset") > 0) | F.col("total").isNull())
                .groupBy("shard", "ordinal").agg(
                    F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("total").alias("total"),
                    F.sort_array(F.collect_list(F.struct("offset", "length", "crc"))).alias("parts"))
                .withColumn("crc", joined("parts")))
    cols = ["doc_id", "start", F.col("total").alias("n_tokens"), F.col("crc").alias("ids_crc32")]
    return whole.select(*cols).unionByName(crossing.select(*cols))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    return documents(spark, write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2))
