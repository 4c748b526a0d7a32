"""Quality rules and host-level verdicts, in DataFrame operations only.

Every text is measured against rules. Failures are summed by host; a host's failure rate
is shrunk towards all hosts' by a beta prior whose parameters are the moments of the
hosts' own rates, so that a small host is judged by its failures only as far as they go.
The verdict on the host comes back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martworks.llm import common

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
#: Repeated words are too many beyond this percentage of the words.
REPEATED_PERCENT = 50
#: A host is rejected when its shrunk failure rate exceeds this.
HOST_LIMIT = 0.5


def _without(text: Column, characters: str, by: str = "") -> Column:
    for c in characters:
        text = F.replace(text, F.lit(c), F.lit(by))
    return text


def _covered(positions: Column) -> Column:
    """Number of words in the three-word windows that start at ``positions`` (rising)."""
    start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("total"))
    return F.aggregate(
        positions,
        start,
        lambda a, p: F.struct(
            (p + 3).alias("end"), (a["total"] + F.least(F.lit(3), p + 3 - a["end"])).alias("total")
        ),
        lambda a: a["total"],
    )


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of every
    row of ``docs`` (doc_id, text, source); a null text has no words."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("host"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    blank = _without(F.col("text"), "\t\n\x0b\x0c\r", " ")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select(
        "doc_id",
        "host",
        F.array_remove(F.split(blank, " "), "").alias("w"),
        F.length(_without(blank, " ")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(_without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        lines.alias("lines"),
    )
    rows = rows.select(
        "doc_id", "host", "word_chars", "n_symbols",
        F.size("w").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        # Hashes of the three-word windows, in order.
        F.when(
            F.size("w") >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size("w") - 3),
                lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")).alias("h"),
    )
    # Only texts with a repeated window are looked at further.
    rows = rows.withColumn(
        "s",
        F.when(
            F.size(F.array_distinct("h")) < F.size("h"),
            F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ),
    )
    again = F.filter(
        "s",
        lambda x, i: (F.get("s", i - 1)["h"] == x["h"]) | F.coalesce(F.get("s", i + 1)["h"] == x["h"], F.lit(False)),
    )
    places = F.array_sort(F.transform(again, lambda x: x["i"]))
    return rows.select(
        "doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(F.when(F.col("s").isNotNull(), _covered(places)), F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words")
    )


@dataclass(frozen=True)
class Prior:
    alpha: float
    beta: float


def hosts(measured: DataFrame) -> DataFrame:
    """Documents and failures by host; documents without one are a host of their own."""
    return measured.groupBy("host").agg(
        F.count("*").alias("host_documents"),
        F.sum(F.col("base_failed").cast("long")).alias("host_failures"),
    )


def beta_prior(by_host: DataFrame) -> Prior:
    """Method of moments over the hosts' rates: strength from the spread that sampling
    does not explain; without such spread (or with one host) a weak prior of strength 2."""
    rate = F.col("host_failures") / F.col("host_documents")
    r = by_host.agg(
        F.sum("host_failures").alias("f"), F.sum("host_documents").alias("n"),
        F.count("*").alias("hosts"), F.avg(rate).alias("mean"), F.var_pop(rate).alias("spread"),
        F.avg(1 / F.col("host_documents")).alias("inverse"),
    ).first()
    if not r["n"]:
        return Prior(1.0, 1.0)
    mean = min(max(r["f"] / r["n"], 1e-6), 1 - 1e-6)
    excess = (r["spread"] or 0.0) - mean * (1 - mean) * r["inverse"]
    strength = 2.0
    if r["hosts"] > 1 and excess > 0:
        strength = min(max(mean * (1 - mean) / excess - 1, 2.0), 1000.0)
    return Prior(mean * strength, (1 - mean) * strength)


def judged(docs: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """Measures and verdicts of every row of ``docs`` (doc_id, text, source): doc_id,
    the measures, base_failed, host, host_documents, host_failures, host_rate (shrunk),
    kept. A row is kept when it passes the rules and its host's shrunk failure rate is
    at most ``host_limit``.

    A null text has no words and fails. Rows without a source share one host. Repeated
    rows count and are answered one by one. An empty table gives an empty result."""
    measured = common.stored(
        measures(docs).withColumn("base_failed", base_failed()), f"{common.folder(docs.sparkSession)}/measures"
    )
    by_host = hosts(measured)
    prior = beta_prior(by_host)
    rated = by_host.select(
        F.col("host").alias("h"), "host_documents", "host_failures",
        (
            (F.col("host_failures") + prior.alpha) / (F.col("host_documents") + prior.alpha + prior.beta)
        ).alias("host_rate"),
    )
    return measured.join(rated, F.col("host").eqNullSafe(F.col("h")), "left").drop("h").withColumn(
        "kept", ~F.col("base_failed") & (F.col("host_rate") <= host_limit)
    )
