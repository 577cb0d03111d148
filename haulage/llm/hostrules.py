"""Operator 10: quality rules of documents and of their hosts. DataFrame functions only.

A document fails the base rules if it has few words or if much of it is in word windows that it
repeats. Per host (``source``), failures are counted, and the rate is drawn towards that of all hosts by a
beta prior fitted to the hosts (method of moments): a host with few documents is judged by the
prior, one with many by its own documents. Documents of hosts over ``host_limit`` go with their host.

Defined results: a missing text has no words and fails; a missing host is a host of its own; repeated
rows are judged each; an empty table gives an empty one; without spread between hosts the prior
weighs as much as ``PLAIN_WEIGHT`` documents. Columns named like those added here are left as they are by
``keep_good``, which returns the given columns only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import written

WINDOW = 8
MIN_WORDS = 20
REPEATED_PERCENT = 30
HOST_LIMIT = 0.5
PLAIN_WEIGHT = 10.0
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def words_of(text: Column) -> Column:
    """Words parted by ASCII white space; none of a missing text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[ \t-\r]+"), "")


def repeated_words(windows: Column, size: int = WINDOW) -> Column:
    """Words in windows found twice or more, given the window hashes in order.

    Sorting (hash, place) puts equal windows side by side; the places of those, sorted again, cover
    ``size`` words each, less what the next one covers too.
    """
    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: (
            (x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"])
        ))
        at = F.array_sort(F.transform(twice, lambda x: x["i"]))
        return _bound(at, lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(
                F.coalesce(F.get(p, j + 1) - x, F.lit(size)), F.lit(size)
            )), F.lit(0).cast("long"), lambda a, x: a + x,
        ))

    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")) \
        .otherwise(_bound(placed, covered))


def _bound(value: Column, then) -> Column:
    """``then(value)`` with the value computed once, however often ``then`` names it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def base_rules(docs: DataFrame, text: str, host: str) -> DataFrame:
    """``doc`` (the given row), ``host``, the counts and ``base_failed``.

    To be written before it is filtered: the optimizer would put the counts' definitions into the filter and
    each other, and a text would be split into words again for every window.
    """
    rows = docs.select(
        F.struct("*").alias("doc"), F.col(host).cast("string").alias("host"),
        F.coalesce(F.col(text), F.lit("")).alias("text"), words_of(F.col(text)).alias("words"),
    )
    marked = rows.select(
        "doc", "host", "text", F.size("words").cast("long").alias("n_words"),
        F.when(F.size("words") > WINDOW, F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW),
            lambda i: F.xxhash64(*[F.get("words", i + j) for j in range(WINDOW)]),
        )).otherwise(F.array().cast("array<bigint>")).alias("windows"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^ \t-\r]")).alias("lines"),
        F.translate("text", SPACES, "").alias("solid"),
    )
    counted = marked.select(
        "doc", "host", "n_words", F.char_length("solid").cast("long").alias("word_chars"),
        (F.char_length("solid") - F.char_length(F.translate("solid", SYMBOLS, "")))
        .cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("windows")).alias("n_repeat_words"),
    )
    return counted.withColumn("base_failed", (
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    ))


def host_verdicts(base: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """One row per host: documents, failures, shrunk rate and whether it is rejected.

    The prior's moments are one row, which alone comes to the driver.
    """
    hosts = base.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("base_failed").cast("long")).alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    alpha, beta = beta_prior(*hosts.agg(F.avg(rate), F.var_samp(rate)).first())
    shrunk = (F.col("n_failed") + alpha) / (F.col("n_docs") + alpha + beta)
    return hosts.withColumn("host_rate", shrunk).withColumn("host_rejected", shrunk > host_limit)


def beta_prior(mean: float | None, variance: float | None) -> tuple[float, float]:
    """Shape of the beta distribution with the hosts' mean and variance.

    One host, equal rates or rates that are all 0 or 1 have no such shape: then the prior has the mean
    and the weight ``PLAIN_WEIGHT``.
    """
    mean = mean or 0.0
    weight = mean * (1 - mean) / variance - 1 if variance else 0.0
    weight = weight if weight > 0 else PLAIN_WEIGHT
    return mean * weight, (1 - mean) * weight


def judge(docs: DataFrame, text: str = "text", host: str = "source", host_limit: float = HOST_LIMIT) -> DataFrame:
    """Every document's ``doc`` (without its text), counts, ``base_failed``, ``host_rate`` and ``kept``.

    The base rules are worked out once and written to the shared folder, without the texts. Hosts are aggregated
    before they are shuffled; Spark broadcasts their verdicts if they are few and else splits the
    join where a host is large.
    """
    base = written(base_rules(docs, text, host).withColumn("doc", F.col("doc").dropFields(text)))
    joined = _with_verdict(base, host_verdicts(base, host_limit))
    return joined.select("doc", "host", *COUNTS, "base_failed", "host_rate",
                         (~F.col("base_failed") & ~F.col("host_rejected")).alias("kept"))


def _with_verdict(base: DataFrame, verdicts: DataFrame) -> DataFrame:
    verdicts = verdicts.select(F.col("host").alias("of_host"), "host_rate", "host_rejected")
    return base.join(verdicts, F.col("host").eqNullSafe(F.col("of_host")))


def keep_good(docs: DataFrame, text: str = "text", host: str = "source",
              host_limit: float = HOST_LIMIT) -> DataFrame:
    """The documents that pass, with their own columns.

    The rules are worked out once: hosts and flags of all rows, and the rows that pass themselves, are written.
    """
    base = base_rules(docs, text, host)
    judged = written(base.select(F.when(~F.col("base_failed"), F.col("doc")).alias("doc"), "host", "base_failed"))
    verdicts = written(host_verdicts(judged, host_limit))
    good = _with_verdict(judged.where(~F.col("base_failed")), verdicts)
    return good.where(~F.col("host_rejected")).select("doc.*")


def op10_hostrules(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return judge(docs).select(F.col("doc.doc_id").alias("doc_id"), *COUNTS, "base_failed", "kept")


ORACLE_SQL = r"""
WITH split AS (
    SELECT doc_id, source, coalesce(text, '') AS text,
           [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+') IF x <> ''] AS words,
           [x FOR x IN string_split(coalesce(text, ''), chr(10))
            IF regexp_matches(x, '[^ \t\n\x0B\f\r]')] AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM split WHERE len(words) >= 8)
), twice AS (
    SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), repeated AS (
    SELECT doc_id, sum(least(8, coalesce(next_i - i, 8))) AS n
    FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS next_i FROM twice) GROUP BY doc_id
), base AS (
    SELECT s.doc_id, s.source, CAST(len(words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
           CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
           CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
    FROM split s LEFT JOIN repeated r USING (doc_id)
), failed AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
), hosts AS (
    SELECT source, count(*) AS n, sum(CAST(base_failed AS BIGINT)) AS f FROM failed GROUP BY source
), moments AS (SELECT avg(f / n) AS m, var_samp(f / n) AS v FROM hosts
), prior AS (
    SELECT m, CASE WHEN v > 0 AND m * (1 - m) / v > 1 THEN m * (1 - m) / v - 1 ELSE 10 END AS weight FROM moments
), verdicts AS (
    SELECT source, (f + m * weight) / (n + weight) > 0.5 AS rejected FROM hosts, prior
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM failed JOIN verdicts ON failed.source IS NOT DISTINCT FROM verdicts.source
"""
