"""Token counts by a map-side two-tier lookup; no pre-token is ever shuffled.

Tier one is a compact table of the lengths (in tokens) of frequent pre-tokens, built once from a bounded
sample of texts and broadcast: at most ``table_entries`` entries of at most ``MAX_KEY_CHARS`` characters.
Tier two is each Python worker's own cache: pre-tokens that miss are encoded by the tokenizers library in
one batch and kept while the cache has room. Either tier only saves work; every count is exact.

Null or empty text: 0 bytes, 0 tokens. Repeated rows and ids are counted row by row. Very long texts are
handled in slices. An empty table gives an empty result. Other columns pass through; input columns named
like an output are replaced.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import compress, repeat
from operator import not_

import pandas as pd
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import tokenizing as tk
from paddock.llm.common import table

MAX_KEY_CHARS = 48


class TwoTierCounter:
    """Counts tokens of texts; ``known`` starts as the broadcast table and grows by the worker's misses."""

    def __init__(self, path: str, frequent: dict[str, int], cache_entries: int):
        tk.check_byte_level(path)
        self.encode = tk.load(path).encode_batch_fast
        self.specials = tk.special_strings(path)
        self.find = regex.compile(tk.PRE_TOKEN).findall
        self.known = dict(frequent)
        self.room = len(frequent) + cache_entries

    def counts(self, texts: list[str | None]) -> list[int]:
        totals = [0] * len(texts)
        missed: list[tuple[int, list[str]]] = []
        get = self.known.get
        for i, text in enumerate(texts):
            for plain, special in tk.by_specials(text or "", self.specials):
                if special:
                    totals[i] += 1
                    continue
                for part in tk.slices(plain):
                    tokens = self.find(part)
                    found = list(map(get, tokens, repeat(0)))
                    totals[i] += sum(found)
                    if 0 in found:
                        missed.append((i, list(compress(tokens, map(not_, found)))))
        if missed:
            new = list(set().union(*(m for _, m in missed)))
            lengths = dict(zip(new, (len(e) for e in self.encode(new, add_special_tokens=False)), strict=True))
            for i, tokens in missed:
                totals[i] += sum(map(lengths.__getitem__, tokens))
            for token, n in lengths.items():
                if len(self.known) >= self.room:
                    break
                self.known[token] = n
        return totals


def frequent_lengths(docs: DataFrame, path: str, text_col: str, sample_docs: int, entries: int) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of at most ``sample_docs`` texts of moderate size."""
    some = docs.where(F.length(text_col) <= 1 << 16).select(text_col).limit(sample_docs).collect()
    find = regex.compile(tk.PRE_TOKEN).findall
    counted: Counter[str] = Counter()
    for r in some:
        counted.update(t for t in find(r[0]) if len(t) <= MAX_KEY_CHARS)
    top = [t for t, _ in counted.most_common(entries)]
    return dict(zip(top, (len(e) for e in tk.load(path).encode_batch_fast(top, add_special_tokens=False)), strict=True))


_workers: dict[str, TwoTierCounter] = {}


def _worker(run: str, path: str, shared: Broadcast, cache_entries: int) -> TwoTierCounter:
    """One counter per worker process and run, so that the cache outlives a task."""
    if run not in _workers:
        _workers.clear()
        _workers[run] = TwoTierCounter(path, shared.value, cache_entries)
    return _workers[run]


def count_tokens(docs: DataFrame, tokenizer_path: str, text_col: str = "text", limit: int = 1024,
                 sample_docs: int = 512, table_entries: int = 1 << 15, cache_entries: int = 400_000) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > ``limit``)."""
    sc = docs.sparkSession.sparkContext
    shared = sc.broadcast(frequent_lengths(docs, tokenizer_path, text_col, sample_docs, table_entries))

    run = uuid.uuid4().hex

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = _worker(run, tokenizer_path, shared, cache_entries)
        for texts in batches:
            yield pd.Series(counter.counts(texts.tolist()), dtype="int64")

    return (docs.withColumn("n_tokens", n_tokens(F.col(text_col)))
            .withColumns({"n_bytes": F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"),
                          "over_limit": F.col("n_tokens") > limit}))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))
            .select("doc_id", "n_bytes", "n_tokens", "over_limit"))
