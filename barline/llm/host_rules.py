"""Quality rules per document, and verdicts on whole hosts.

Each text is measured by itself. Failures of the rules are then counted by host,
the hosts' failure rates are shrunk towards the beta prior that fits their spread,
and hosts above a rate lose all their documents. Text never shuffles: only
per-host counts do, combined before the shuffle, so a hot host costs nothing more.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.tokens import SPACE, mix, owner, slices, texts, window_hashes, word_hashes, words
from barline.session import stage

WINDOW = 5
#: A host is rejected if its shrunk failure rate is above this.
MAX_HOST_RATE = 0.6
_CONTINUATION = bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _dup_lines(text: bytes) -> int:
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def measure(column: pa.Array) -> dict[str, np.ndarray]:
    """The five counts of each text. Windows compare by a 64-bit hash within a text."""
    raw = column.cast(pa.large_binary()).to_pylist()
    offsets, flat = words(column)
    n = np.diff(offsets)
    who = owner(offsets)
    keys = mix(window_hashes(word_hashes(flat), WINDOW) ^ mix(who))
    whole = np.arange(len(who)) + WINDOW <= offsets[who + 1] if len(who) else np.zeros(0, bool)
    starts = np.flatnonzero(whole)
    order = starts[np.argsort(keys[starts])]
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(who) + WINDOW, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    inside = twice.copy()
    for k in range(1, WINDOW):
        inside[k:] |= twice[:-k]
    repeats = np.bincount(who, weights=inside[: len(who)], minlength=len(n)).astype(np.int64)
    return {
        "n_words": n,
        "word_chars": np.array([len(t.translate(None, SPACE + _CONTINUATION)) for t in raw], np.int64),
        "n_symbols": np.array([len(t) - len(t.translate(None, _SYMBOLS)) for t in raw], np.int64),
        "n_dup_lines": np.array([_dup_lines(t) for t in raw], np.int64),
        "n_repeat_words": repeats,
    }


def _measure_batches(batches):
    for batch in batches:
        for part in slices(batch, "text"):
            got = measure(texts(part.column("text")))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("host"), *[pa.array(got[c]) for c in COUNTS]],
                ["doc_id", "host", *COUNTS])


def document_counts(docs: DataFrame, host_col: str = "source") -> DataFrame:
    """doc_id, host and the five counts of each row; a null text has zeros."""
    rows = docs.select("doc_id", F.col(host_col).alias("host"), "text")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", F.col("host").cast("string").alias("host"), F.col("text").cast("string").alias("text")).mapInArrow(
        _measure_batches, f"doc_id {id_type}, host string, " + ", ".join(f"{c} long" for c in COUNTS))


def _failed() -> tuple:
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    symbols = 10 * F.col("n_symbols") > 5 * F.col("n_words")
    return base, symbols


def host_rates(counted: DataFrame) -> DataFrame:
    """host, documents, failures and the shrunk failure rate.

    The prior is the beta distribution with the mean and variance of the hosts' raw
    rates. With one host, or rates that vary no more than chance allows a beta
    distribution to (variance 0, or at least mean * (1 - mean)), it has weight 1.
    """
    hosts = counted.groupBy("host").agg(
        F.count(F.lit(1)).alias("docs"), F.sum(F.col("failed").cast("long")).alias("failures"))
    rate = F.col("failures") / F.col("docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_samp(rate).alias("v")).first()
    m, v = prior["m"] or 0.0, prior["v"] or 0.0
    k = m * (1 - m) / v - 1 if 0 < v < m * (1 - m) else 1.0
    return hosts.select("host", "docs", "failures",
                        ((F.col("failures") + m * k) / (F.col("docs") + k)).alias("host_rate"))


def quality_rules(docs: DataFrame, host_col: str = "source", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Counts, base rule and verdict of each document.

    A document is kept if it passes the base rule and its host's shrunk rate of
    rule failures (base rule, or more than one symbol to two words) is at most
    ``max_rate``. Null text: no words, so the base rule fails. Null host: a host
    of its own. Repeated rows count and come out once each; null ids stay; a table without
    rows gives none; texts are read whole, however long; extra columns are ignored.
    """
    base, symbols = _failed()
    counted = document_counts(docs, host_col).withColumn("base_failed", base).withColumn("failed", base | symbols)
    counted = stage(counted, "rules")  # read twice: for the hosts and for the result
    rates = host_rates(counted)
    a, b = counted.alias("a"), rates.alias("b")
    joined = a.join(b, F.col("a.host").eqNullSafe(F.col("b.host")), "left")
    return joined.select(
        "a.doc_id", *[f"a.{c}" for c in COUNTS], "a.base_failed",
        (~F.col("a.base_failed") & (F.col("b.host_rate") <= max_rate)).alias("kept"),
        F.round("b.host_rate", 6).alias("host_rate"))


SQL = r"""
WITH w AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(ws[i:i+4], ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
rep AS (
  SELECT doc_id, count(DISTINCT i + j) AS n FROM (
    SELECT doc_id, i, unnest(range(0, 5)) AS j FROM (
      SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, k) AS c FROM win) WHERE c > 1)
  GROUP BY doc_id),
ln AS (
  SELECT doc_id, count(*) - count(DISTINCT l) AS n FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM w)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (
  SELECT w.doc_id, host, len(ws)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    coalesce(ln.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN ln USING (doc_id) LEFT JOIN rep USING (doc_id)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (
  SELECT host, count(*) AS docs,
    sum((base_failed OR 10 * n_symbols > 5 * n_words)::BIGINT)::DOUBLE AS failures FROM f GROUP BY host),
p AS (SELECT avg(failures / docs) AS m, var_samp(failures / docs) AS v FROM h),
k AS (SELECT m, CASE WHEN v > 0 AND v < m * (1 - m) THEN m * (1 - m) / v - 1 ELSE 1.0 END AS k FROM p),
r AS (SELECT host, (failures + m * k) / (docs + k) AS host_rate FROM h, k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_rate <= 0.6 AS kept, round(host_rate, 6) AS host_rate
FROM f JOIN r ON f.host IS NOT DISTINCT FROM r.host
"""


def op2_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))
