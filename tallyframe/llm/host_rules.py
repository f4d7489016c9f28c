"""Quality rules judged per document and per host, in native columns only.

Every document is measured on its whole text and tested by rules. Failures are
counted per host, a host's rate is drawn towards a beta prior fitted to all
hosts, and the host's verdict is joined back to its documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyframe.staging import stage

BLANKS = "[\\x20\\x09-\\x0D]+"
NOT_BLANK = "[^\\x20\\x09-\\x0D]"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8


@dataclass(frozen=True)
class Limits:
    """Limits of the rules; a document or host beyond one of them fails."""

    min_words: int = 20
    max_repeat_pct: int = 30
    max_symbols_per_100_words: int = 50
    max_dup_lines_pct: int = 50
    max_mean_word_chars: int = 20
    max_host_rate: float = 0.5


def repeated_words(words: Column, size: int = WINDOW) -> Column:
    """Words under windows of ``size`` words that occur twice or more in the array.

    Windows are compared by 64-bit hashes, within one document only; sorting
    them brings equal ones together. Linear but for that sort.
    """

    def windows(hashes: Column) -> Column:
        places = F.sequence(F.lit(1), F.size(hashes) - size + 1)
        return F.when(
            F.size(hashes) > size, F.transform(places, lambda i: F.xxhash64(F.slice(hashes, i, size)))
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(found: Column) -> Column:
        placed = F.sort_array(F.transform(found, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(ordered: Column) -> Column:
            at = F.filter(
                F.sequence(F.lit(0), F.size(ordered) - 1),
                lambda j: (F.get(ordered, j)["h"] == F.get(ordered, j - 1)["h"])
                | (F.get(ordered, j)["h"] == F.get(ordered, j + 1)["h"]),
            )
            return F.sort_array(F.transform(at, lambda j: F.get(ordered, j)["i"]))

        def join(state: Column, start: Column) -> Column:
            total = state["total"] + F.least(F.lit(size), start - state["last"])
            return F.struct(start.alias("last"), total.alias("total"))

        first = F.struct(F.lit(-size).alias("last"), F.lit(0).alias("total"))
        return _bind(placed, lambda p: F.aggregate(starts(p), first, join, lambda s: s["total"]))

    found = _bind(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return _bind(
        found,
        lambda found: F.when(F.size(F.array_distinct(found)) < F.size(found), covered(found)).otherwise(F.lit(0)),
    ).cast("long")


def _bind(value: Column, body) -> Column:
    """``body`` over ``value``, which is computed once and not again for every element of a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measure(docs: DataFrame, text_col: str = "text", prefix: str = "") -> DataFrame:
    """Add the measures of every whole text (a null text counts as empty)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_BLANK))
    split = docs.withColumn(f"{prefix}words", F.array_remove(F.split(text, BLANKS), ""))
    split = split.withColumn(f"{prefix}lines", lines)
    words, lines = F.col(f"{prefix}words"), F.col(f"{prefix}lines")
    measures = {
        "n_words": F.size(words),
        "word_chars": F.length(F.array_join(words, "")),
        "n_symbols": F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, "")),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_repeat_words": repeated_words(words),
        "n_lines": F.size(lines),
    }
    added = split.select(*docs.columns, *(c.cast("long").alias(f"{prefix}{n}") for n, c in measures.items()))
    return added


def rule_failures(limits: Limits = Limits(), prefix: str = "") -> dict[str, Column]:
    """A boolean column per rule; ``few_words`` and ``repeats`` are the base rules."""
    col = lambda name: F.col(f"{prefix}{name}")
    return {
        "few_words": col("n_words") < limits.min_words,
        "repeats": col("n_repeat_words") * 100 > col("n_words") * limits.max_repeat_pct,
        "symbols": col("n_symbols") * 100 > col("n_words") * limits.max_symbols_per_100_words,
        "dup_lines": col("n_dup_lines") * 100 > col("n_lines") * limits.max_dup_lines_pct,
        "long_words": col("word_chars") > col("n_words") * limits.max_mean_word_chars,
    }


@dataclass(frozen=True)
class BetaPrior:
    failures: float
    passes: float


def beta_prior(hosts: DataFrame) -> BetaPrior:
    """Moments of the hosts' failure rates; reads one aggregated row.

    Rates that differ no more than chance would have it give a strong prior,
    whose strength is held to the number of documents per host.
    """
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    row = hosts.agg(F.sum(n), F.sum(f), F.sum(f * f / n), F.count("*")).first()
    docs, failed, squares, count = (float(x or 0) for x in row)
    if docs == 0:
        return BetaPrior(0.5, 0.5)
    mean = failed / docs
    spread = mean * (1 - mean)
    most = max(1.0, docs / count)
    if spread == 0 or docs == count:
        strength = most if spread == 0 else 1.0
    else:
        share = count / docs
        rho = ((squares - docs * mean * mean) / docs / spread - share) / (1 - share)
        strength = min(most, max(1.0, 1 / rho - 1)) if rho > 0 else most
    # Half a document on either side keeps the rate inside (0, 1).
    return BetaPrior(mean * strength + 0.5, (1 - mean) * strength + 0.5)


def host_verdicts(measured: DataFrame, host_col: str, prior: BetaPrior | None, limits: Limits = Limits()) -> DataFrame:
    """``(host, n_docs, n_failed, host_rate, host_rejected)``; a null host has no row."""
    hosts = (
        measured.where(F.col(host_col).isNotNull())
        .groupBy(F.col(host_col).alias("_host"))
        .agg(F.count("*").alias("n_docs"), F.sum(F.col("failed").cast("long")).alias("n_failed"))
    )
    prior = prior or beta_prior(hosts)
    rate = (F.col("n_failed") + prior.failures) / (F.col("n_docs") + prior.failures + prior.passes)
    return hosts.withColumn("host_rate", rate).withColumn("host_rejected", rate > limits.max_host_rate)


def judge(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """Measures, failed rules, host rate and verdict of every document.

    Returns ``(id_col, host, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, failed_rules, base_failed, host_rate,
    host_rejected, kept)``. One row per row of ``docs``, repeated rows counted
    and returned each; a null text is empty and fails ``few_words``; documents
    without a host are judged alone (null rate, never rejected); other columns
    are left out and may have any name; an empty table gives no rows.

    Runs jobs: measures (no texts) are staged once, and hosts are counted from
    them. The host join is an equality join that adaptive execution broadcasts
    or splits by the measured sizes.
    """
    rows = docs.select(
        F.col(id_col).alias("_id"), F.col(host_col).alias("_source"), F.col(text_col).alias("_text")
    )
    measured = measure(rows, "_text").drop("_text")
    rules = rule_failures(limits)
    failed = F.filter(
        F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in rules.items())), lambda x: x.isNotNull()
    )
    base = rules["few_words"] | rules["repeats"]
    staged = stage(
        measured.withColumn("failed_rules", failed)
        .withColumn("base_failed", base)
        .withColumn("failed", F.size("failed_rules") > 0),
        "host-rules",
    )
    verdicts = host_verdicts(staged, "_source", None, limits).select("_host", "host_rate", "host_rejected")
    joined = staged.join(verdicts, staged["_source"] == verdicts["_host"], "left")
    rejected = F.coalesce("host_rejected", F.lit(False))
    return joined.select(
        F.col("_id").alias(id_col),
        F.col("_source").alias("host"),
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines"),
        "failed_rules",
        "base_failed",
        "host_rate",
        rejected.alias("host_rejected"),
        (~F.col("base_failed") & ~rejected).alias("kept"),
    )
