"""Quality rules with adaptive thresholds from mergeable quantile sketches; DataFrame functions only.

Base figures per document: words, their characters, symbols, repeated lines, and words in three-word windows that
occur again. Each of four ratios of them (``MEASURES``, in whole thousandths) goes into a quantile sketch per language and
source: a histogram with exact buckets below 256 and 128 buckets per power of two above, so within 1 %. Sketches are
counts, so they combine before the shuffle, in any order to the same result, and merge by adding: the
sketches of a language's sources give the language's, and these the whole corpus's.

A document is kept if it does not fail the base rule and each ratio lies within its group's fences, the quartiles widened by
``spread`` times the distance between them plus the measure's slack. A group of fewer than ``least_rows`` documents takes
its language's fences, and a language of fewer the corpus's. So a ratio that is usual in its group is never held
against a document, and only outliers go. Fences join the documents null-safely; null languages and sources are groups.

A null or empty text has no words, fails the base rule and is in no sketch. Repeated rows and ids are judged row by row. An
empty table gives an empty result. Three-word windows are compared by 64-bit hashes, within one text only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from paddock.llm.common import landed, table

# Words, symbols, and the base rule's limits.
WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50

#: measure -> (per thousand, whether a small value is an outlier too, slack in thousandths)
MEASURES = {
    "symbols": (lambda: 1000 * F.col("n_symbols"), False, 100),
    "dup_lines": (lambda: 1000 * F.col("n_dup_lines"), False, 100),
    "repeats": (lambda: 1000 * F.col("n_repeat_words"), False, 150),
    "word_length": (lambda: 1000 * F.col("word_chars"), True, 1000),
}


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def repeat_words(words: Column) -> Column:
    """Number of words in three-word windows that occur at least twice."""

    def covered(places: Column) -> Column:
        ahead = F.transform(places, lambda p, k: F.when(k == F.size(places) - 1, 3).otherwise(F.least(F.lit(3), F.get(places, k + 1) - p)))
        return F.aggregate(ahead, F.lit(0).cast("long"), lambda a, n: a + n)

    def of_sorted(pairs: Column) -> Column:
        again = F.filter(pairs, lambda e, k: (e["h"] == F.get(pairs, k - 1)["h"]) | (e["h"] == F.get(pairs, k + 1)["h"]))
        return _let(F.sort_array(F.transform(again, lambda e: e["i"])), covered)

    def of_grams(grams: Column) -> Column:
        pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), F.lit(0).cast("long")).otherwise(_let(pairs, of_sorted))

    grams = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_let(grams, of_grams))


def figures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long) and base_failed."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    per_words = _let(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeat_words(w).alias("n_repeat_words")))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    dup_lines = _let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return (docs.withColumns({"_w": per_words, "n_symbols": F.regexp_count(text, F.lit(SYMBOL)).cast("long"), "n_dup_lines": dup_lines})
            .withColumns({n: F.col(f"_w.{n}") if n not in ("n_symbols", "n_dup_lines") else F.col(n) for n in names}).drop("_w")
            .withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))))


def ratio(measure: str) -> Column:
    """A measure in whole thousandths per word; null without words."""
    return F.when(F.col("n_words") > 0, F.floor(MEASURES[measure][0]() / F.col("n_words")))


def bucket(value: Column) -> Column:
    """The lower end of a value's bucket."""
    drop = F.pow(F.lit(2), F.greatest(F.length(F.bin(value)) - 8, F.lit(0))).cast("long")
    return value - value % drop


def sketches(rows: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: one quantile sketch per language, source and measure."""
    values = F.array(*(F.struct(F.lit(m).alias("measure"), bucket(F.col(f"_{m}")).alias("bucket")) for m in MEASURES))
    return (rows.where("n_words > 0").select("lang", "source", F.explode(values).alias("v"))
            .groupBy("lang", "source", "v.measure", "v.bucket").agg(F.count("*").alias("n")))


def merged(sketch: DataFrame, *by: str) -> DataFrame:
    """Sketches of larger groups: the counts added up."""
    return sketch.groupBy(*by, "measure", "bucket").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, by: list[str], spread: int) -> DataFrame:
    """Per group and measure: rows, low and high."""
    group = W.partitionBy(*by, "measure")
    ranked = sketch.withColumns({"upto": F.sum("n").over(group.orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)), "rows": F.sum("n").over(group)})
    at = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("rows"), F.col("bucket")))
    slack = F.element_at(F.create_map(*(F.lit(x) for m, (_, _, s) in MEASURES.items() for x in (m, s))), F.col("measure"))
    low = F.element_at(F.create_map(*(F.lit(x) for m, (_, b, _) in MEASURES.items() for x in (m, b))), F.col("measure"))
    wide = spread * (F.col("q3") - F.col("q1")) + slack
    return (ranked.groupBy(*by, "measure").agg(F.max("rows").alias("rows"), at(1).alias("q1"), at(3).alias("q3"))
            .select(*by, "measure", "rows", F.when(low, F.col("q1") - wide).alias("low"), (F.col("q3") + wide).alias("high")))


def thresholds(rows: DataFrame, spread: int, least_rows: int) -> DataFrame:
    """lang, source and, per measure, low_ and high_: the group's fences, its language's or the corpus's."""
    by_source = landed(sketches(rows), "quantiles")
    by_lang = merged(by_source, "lang")
    own = fences(by_source, ["lang", "source"], spread)
    lang = fences(by_lang, ["lang"], spread).toDF("_lang", "_m1", "rows1", "low1", "high1")
    whole = fences(merged(by_lang), [], spread).toDF("_m2", "rows2", "low2", "high2")
    joined = (own.join(lang, F.col("lang").eqNullSafe(F.col("_lang")) & (F.col("measure") == F.col("_m1")))
              .join(whole, F.col("measure") == F.col("_m2")))
    pick = lambda x: F.when(F.col("rows") >= least_rows, F.col(x)).when(F.col("rows1") >= least_rows, F.col(x + "1")).otherwise(F.col(x + "2"))
    one = lambda m, x: F.max(F.when(F.col("measure") == m, pick(x))).alias(f"{x}_{m}")
    return landed(joined.groupBy("lang", "source").agg(*(one(m, x) for m in MEASURES for x in ("low", "high"))), "fences")


def judge(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",), text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          spread: int = 3, least_rows: int = 40) -> DataFrame:
    """The columns ``carry`` of ``docs``, the base figures, base_failed, and kept."""
    own = docs.select(*(F.col(c).alias(f"c_{c}") for c in carry), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"))
    rows = landed(figures(own).drop("text"), "figures").withColumns({f"_{m}": ratio(m) for m in MEASURES})
    limits = thresholds(rows, spread, least_rows).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    inside = F.lit(True)
    for m, (_, both, _) in MEASURES.items():
        inside = inside & (F.col(f"_{m}") <= F.col(f"high_{m}")) & ((F.col(f"_{m}") >= F.col(f"low_{m}")) if both else F.lit(True))
    out = (rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
           .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False))))
    return out.select(*(F.col(f"c_{c}").alias(c) for c in carry), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    ratios = {"symbols": "n_symbols", "dup_lines": "n_dup_lines", "repeats": "n_repeat_words", "word_length": "word_chars"}
    values = "\n    UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS m, {s} AS slack, {str(both).lower()} AS low_too, 1000 * {ratios[m]} // n_words AS v FROM f WHERE n_words > 0"
                                     for m, (_, both, s) in MEASURES.items())
    return rf"""
WITH w AS (SELECT doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
r AS (SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS k FROM again) GROUP BY doc_id),
f AS (SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
v AS ({values}),
b AS (SELECT *, v - v % CAST(pow(2, greatest(length(bin(v)) - 8, 0)) AS BIGINT) AS bucket FROM v),
own AS (SELECT lang, source, m, slack, low_too, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM b GROUP BY ALL),
per_lang AS (SELECT lang, m, count(*) AS n, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM b GROUP BY ALL),
whole AS (SELECT m, quantile_disc(bucket, 0.25) AS q1, quantile_disc(bucket, 0.75) AS q3 FROM b GROUP BY ALL),
q AS (SELECT own.lang, own.source, own.m, slack, low_too,
        CASE WHEN own.n >= 40 THEN own.q1 WHEN per_lang.n >= 40 THEN per_lang.q1 ELSE whole.q1 END AS q1,
        CASE WHEN own.n >= 40 THEN own.q3 WHEN per_lang.n >= 40 THEN per_lang.q3 ELSE whole.q3 END AS q3
        FROM own JOIN per_lang ON own.lang IS NOT DISTINCT FROM per_lang.lang AND own.m = per_lang.m JOIN whole ON own.m = whole.m),
ok AS (SELECT doc_id, bool_and(v <= q3 + 3 * (q3 - q1) + q.slack AND (NOT q.low_too OR v >= q1 - 3 * (q3 - q1) - q.slack)) AS inside
        FROM v JOIN q ON v.m = q.m AND v.lang IS NOT DISTINCT FROM q.lang AND v.source IS NOT DISTINCT FROM q.source GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(inside, false) AS kept
FROM f LEFT JOIN ok USING (doc_id)
"""


ORACLE = _oracle()
