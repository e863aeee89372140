"""Quality rules judged by document and by host, in DataFrame functions alone.

Words are runs of characters that are no ASCII white space. Each document gets its counts and the rules that it fails.
The share of failing documents of a host is shrunk towards all hosts by an empirical beta prior (moments of the hosts'
rates), so that a host with two documents is not condemned by one. On a host whose shrunk rate reaches `host_limit`,
documents that fail any rule go; elsewhere only those that fail a base rule. A document without failures is kept
wherever it comes from.

Defined cases: null or empty text has no words and fails; documents without a host are one host of their own; repeated
rows are judged each by itself and count each; an empty table gives an empty result. Other columns, whatever their
names, take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskmart.llm import store

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
HOST_LIMIT = 0.5
STRENGTH = (10.0, 1000.0)  # bounds of the prior's weight in documents
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of `docs` inside the struct `row`, and the counts of its text.

    Repeated windows are found inside the row: hashes of all windows, and only where two agree are they sorted with
    their places. Nothing is shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    bare = F.btrim(body, F.lit(SPACE))
    rows = docs.select(F.struct("*").alias("row"), body.alias("_text"),
                       F.when(bare == "", F.array().cast("array<string>"))
                       .otherwise(F.split(bare, r"[\x20\x09-\x0D]+")).alias("_words"),
                       F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"))
    n = F.size("_words")
    windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), n - WINDOW + 1),
                                              lambda i: F.xxhash64(F.slice("_words", i, WINDOW))))
    rows = rows.select(
        "row", n.cast("long").alias("n_words"),
        F.length(F.translate("_text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        windows.alias("_windows"))
    placed = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    rows = rows.withColumn("_sorted", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), placed))
    same = F.filter("_sorted", lambda x, i: F.coalesce(
        (x["h"] == F.get("_sorted", i - 1)["h"]) | (x["h"] == F.get("_sorted", i + 1)["h"]),
        x["h"] == F.get("_sorted", i + 1)["h"], x["h"] == F.get("_sorted", i - 1)["h"], F.lit(False)))
    at = F.array_sort(F.transform(same, lambda x: x["i"]))
    covered = F.aggregate(at, F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")), lambda s, p: F.struct(
        p.alias("last"), (s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n")))["n"]
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("_windows", "_sorted")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def failed() -> Column:
    """Any rule: the base ones, many symbols, many repeated lines, words of unusual length."""
    return (base_failed() | (10 * F.col("n_symbols") > F.col("n_words"))
            | (10 * F.col("n_dup_lines") > 3 * F.col("n_lines"))
            | (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words")))


def host_rates(judged: DataFrame) -> DataFrame:
    """One row per host: documents, failures and the shrunk rate. The prior is two numbers, read by the driver."""
    hosts = store.stage(judged.groupBy("host").agg(
        F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("n_failed")), "hosts")
    rate = F.col("n_failed") / F.col("n")
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    alpha, beta = prior(mean, var)
    return hosts.withColumn("host_rate", (F.col("n_failed") + alpha) / (F.col("n") + (alpha + beta)))


def prior(mean: float | None, var: float | None) -> tuple[float, float]:
    """Beta parameters with the given moments; their sum stays within STRENGTH."""
    if mean is None:
        return STRENGTH[0] / 2, STRENGTH[0] / 2  # no hosts at all
    weight = mean * (1 - mean) / var - 1 if var else STRENGTH[1]
    weight = min(max(weight, STRENGTH[0]), STRENGTH[1])
    return mean * weight, (1 - mean) * weight


def judge(docs: DataFrame, host: str = "source", text: str = "text", host_limit: float = HOST_LIMIT) -> DataFrame:
    """doc_id (in the struct `row`), host, counts, base_failed, failed, host_rate and kept of each row.

    The counts are stored once; the host table is joined back by shuffle with skew splitting, or broadcast when its
    stored size is below the session's threshold.
    """
    rows = measure(docs, text)
    rows = rows.select(F.struct("row.doc_id").alias("row"), F.col(f"row.{host}").alias("host"), *COUNTS, base_failed().alias("base_failed"), failed().alias("failed"))
    judged = store.stage(rows, "quality")
    rates = host_rates(judged).select(F.col("host").alias("_host"), "host_rate")
    joined = judged.join(rates, F.col("host").eqNullSafe(F.col("_host")), "left").drop("_host")
    return joined.withColumn("kept", _kept(host_limit))


def _kept(host_limit: float) -> Column:
    """One condition that names both sides of the join with the hosts. A part of it that named the document alone would be
    pushed below the projections of the counts, which then would be computed anew for every word."""
    return F.when(F.col("host_rate") >= host_limit, ~F.col("failed")).otherwise(~F.col("base_failed"))


def kept_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows that are kept, with their own columns only.

    Counts are computed once for the hosts and again for the rows: cheaper than to store or shuffle whole texts.
    """
    host = options.get("host", "source")
    counts = measure(docs, options.get("text", "text")).select(F.col(f"row.{host}").alias("host"), failed().alias("failed"))
    rates = host_rates(store.stage(counts, "quality")).select(F.col("host").alias("_host"), "host_rate")
    rows = measure(docs, options.get("text", "text"))
    judged = rows.select("row", F.col(f"row.{host}").alias("host"), base_failed().alias("base_failed"), failed().alias("failed"))
    joined = judged.join(store.stage(rates, "host-rates"), F.col("host").eqNullSafe(F.col("_host")), "left")
    return joined.where(_kept(options.get("host_limit", HOST_LIMIT))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    return judge(store.table(spark, sf_dir, "documents").select("doc_id", "source", "text")).select(
        "row.doc_id", *COUNTS, "base_failed", "kept")


SQL = rf"""
WITH m AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
line AS (
  SELECT doc_id, u.l FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM m) u
  WHERE regexp_matches(u.l, '[^\x20\x09-\x0D]')),
lines AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM line GROUP BY doc_id),
win AS (
  SELECT doc_id, i, list_slice(w, i, i + {WINDOW - 1}) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM m WHERE len(w) >= {WINDOW})),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_rep
  FROM (SELECT doc_id, unnest(range(i, i + {WINDOW})) AS p
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1) GROUP BY doc_id),
n AS (
  SELECT m.doc_id, m.source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_rep, 0) AS BIGINT) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines
  FROM m LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
j AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words AS base_failed,
         n_words < {MIN_WORDS} OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
         OR 10 * n_dup_lines > 3 * n_lines OR word_chars < 3 * n_words OR word_chars > 12 * n_words AS failed FROM n),
h AS (SELECT source, count(*) AS c, count(*) FILTER (failed) AS f FROM j GROUP BY source),
q AS (SELECT avg(f / c) AS mean, var_pop(f / c) AS var FROM h),
p AS (SELECT mean, least(greatest(CASE WHEN var > 0 THEN mean * (1 - mean) / var - 1 ELSE {STRENGTH[1]} END,
                                  {STRENGTH[0]}), {STRENGTH[1]}) AS k FROM q),
r AS (SELECT source, (f + mean * k) / (c + k) AS rate FROM h, p)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (rate >= {HOST_LIMIT} AND failed) AS kept
FROM j JOIN r ON j.source IS NOT DISTINCT FROM r.source
"""
