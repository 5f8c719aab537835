"""Quality rules per document and per host.

A document fails its own (base) rules when it is short or repeats itself. A host (any
column that names where a document comes from) is rejected when its share of documents
that fail some rule, shrunk to an empirical beta prior, passes a limit: a host with a
few failures is pulled to the average of all hosts, a host with thousands speaks for
itself. Verdicts are joined back to the documents.

Everything is Column expressions. One scan measures the texts; counts per host combine
on the map side, so a host with a third of all rows costs a row per task; only the
rejected hosts are joined, and Spark broadcasts that table by its written size or
shuffles it.

Defined results: a null or empty text has no words and fails; a null host is never
rejected; an empty table gives no rows; repeated rows are judged alike; columns of the
input keep their names, and computed columns are returned under the names below, so the
input must be narrowed (``carry``) where they clash - a clash raises ``ValueError``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import Stages, text_of, words_of

WINDOW = 5
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
VERDICTS = ["base_failed", "host_rejected", "kept"]


@dataclass(frozen=True)
class RuleLimits:
    """Limits of the document rules and of a host's shrunk failure rates."""

    min_words: int = 10
    max_repeat_percent: int = 20
    max_symbols_per_word: float = 0.5
    max_dup_line_percent: int = 50
    max_host_rate: float = 0.75


def with_measures(docs: DataFrame, text: str, carry: Sequence[str]) -> DataFrame:
    """Columns ``carry`` and the counts of ``MEASURES``, one row per input row.

    Windows are compared by hash first: hashes that all differ prove that no window
    repeats. Only texts with equal hashes compare the windows themselves.
    """
    kept = [F.col(f"`{c}`") for c in carry]
    first = docs.select(*kept, text_of(f"`{text}`").alias("__text"))
    parts = first.select(
        *kept, "__text", words_of(F.col("__text")).alias("__words"),
        F.filter(
            F.split("__text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
        ).alias("__lines"),
    )
    at = F.col("__words")
    hashed = F.slice(
        F.transform(at, lambda w, i: F.xxhash64(w, *(F.get(at, i + k) for k in range(1, WINDOW)))),
        F.lit(1), F.size(at) - (WINDOW - 1),
    )
    windows = parts.withColumn(
        "__hashes", F.when(F.size(at) >= WINDOW, hashed).otherwise(F.array().cast("array<bigint>"))
    )
    spelled = F.transform(
        "__hashes",
        lambda h, i: F.struct(F.array_join(F.slice(at, i + 1, WINDOW), " ").alias("w"), i.alias("i")),
    )
    repeats = F.size("__hashes") > F.size(F.array_distinct("__hashes"))
    ordered = windows.withColumn(
        "__sorted",
        F.when(repeats, F.array_sort(spelled)).otherwise(F.array().cast("array<struct<w:string,i:int>>")),
    )
    follows = F.slice("__sorted", F.lit(2), F.size("__sorted"))
    starts = ordered.withColumn(
        "__starts",
        F.array_sort(F.array_distinct(F.flatten(F.zip_with(
            "__sorted", follows,
            lambda a, b: F.when(a["w"] == b["w"], F.array(a["i"], b["i"])).otherwise(
                F.array().cast("array<int>")
            ),
        )))),
    )
    covered = F.aggregate(
        F.zip_with(
            "__starts", F.slice("__starts", F.lit(2), F.size("__starts")),
            lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))),
        ),
        F.lit(0), lambda total, x: total + x,
    )
    counts = {
        "n_words": F.size("__words"),
        "word_chars": F.length(F.array_join("__words", "")),
        "n_symbols": F.length("__text") - F.length(F.regexp_replace("__text", r"[#*$%&|<>]", "")),
        "n_lines": F.size("__lines"),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": covered,
    }
    return starts.select(*kept, *(c.cast("long").alias(n) for n, c in counts.items()))


def _failures(limits: RuleLimits) -> dict[str, Column]:
    words = F.col("n_words")
    return {
        "short": words < limits.min_words,
        "repetitive": 100 * F.col("n_repeat_words") > limits.max_repeat_percent * words,
        "symbols": F.col("n_symbols") > limits.max_symbols_per_word * words,
        "dup_lines": 100 * F.col("n_dup_lines") > limits.max_dup_line_percent * F.col("n_lines"),
    }


def host_verdicts(
    measured: DataFrame, host: str, stages: Stages, limits: RuleLimits = RuleLimits()
) -> DataFrame:
    """Hosts with their counts, shrunk rates per rule and the verdict ``host_rejected``.

    The prior of a rule has the mean of all documents and, by moments, the spread of the
    host rates that chance does not explain; without such a spread it outweighs any host.
    """
    rules = _failures(limits)
    hosts = stages.keep(
        measured.filter(F.col(f"`{host}`").isNotNull()).groupBy(F.col(f"`{host}`").alias("host")).agg(
            F.count("*").alias("n"), *(F.count_if(c).alias(f"f_{r}") for r, c in rules.items())
        ),
        "hosts",
    )
    totals = hosts.agg(
        F.sum("n").alias("n"), F.count("*").alias("hosts"),
        *(F.sum(f"f_{r}").alias(f"f_{r}") for r in rules),
        *(F.sum(F.col(f"f_{r}") * F.col(f"f_{r}") / F.col("n")).alias(f"s_{r}") for r in rules),
    ).first()  # one row
    rejected = F.lit(False)
    for rule in rules:
        alpha, beta = beta_prior(totals["n"], totals["hosts"], totals[f"f_{rule}"], totals[f"s_{rule}"])
        rate = (F.col(f"f_{rule}") + alpha) / (F.col("n") + alpha + beta)
        hosts = hosts.withColumn(f"rate_{rule}", rate)
        rejected = rejected | (rate > limits.max_host_rate)
    return hosts.withColumn("host_rejected", rejected)


def beta_prior(n: int | None, hosts: int, failed: int | None, squares: float | None) -> tuple[float, float]:
    """Alpha and beta from totals over hosts: rows, hosts, failures, sum of failures²/rows."""
    if not n:
        return 0.5, 0.5
    mean = (failed + 0.5) / (n + 1)
    spread = max(squares / n - (failed / n) ** 2, 0.0)
    chance = mean * (1 - mean) * hosts / n
    extra = max(spread - chance, mean * (1 - mean) / 1e6)
    strength = max(mean * (1 - mean) / extra - 1, 0.1)
    return mean * strength, (1 - mean) * strength


def quality_rules(
    docs: DataFrame, text: str = "text", host: str = "source", carry: Sequence[str] | None = None,
    limits: RuleLimits = RuleLimits(), stages: Stages | None = None,
) -> DataFrame:
    """``carry`` (default: all columns) with measures, ``base_failed``, ``host_rejected``, ``kept``."""
    carry = list(docs.columns if carry is None else carry)
    clash = {c.lower() for c in carry} & {*MEASURES, *VERDICTS, "__host"}
    if clash:
        raise ValueError(f"columns {sorted(clash)} are also computed; rename them or leave them out")
    stages = stages or Stages(docs.sparkSession)
    with_host = docs.withColumn("__host", F.col(f"`{host}`"))
    measured = stages.keep(with_measures(with_host, text, [*carry, "__host"]), "measures")
    verdicts = host_verdicts(measured, "__host", stages, limits)
    rejected = stages.keep(
        verdicts.filter("host_rejected").select(F.col("host").alias("__host"), "host_rejected"), "rejected"
    )
    rules = _failures(limits)
    return (
        measured.join(rejected, "__host", "left")
        .withColumn("base_failed", rules["short"] | rules["repetitive"])
        .withColumn("host_rejected", F.coalesce("host_rejected", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
        .select(*(F.col(f"`{c}`") for c in carry), *MEASURES, *VERDICTS)
    )
