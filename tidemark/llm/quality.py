"""Quality rules at host level, with DataFrame functions only.

Each document is measured and checked against rules: the base rules (few words, mostly repeated windows), many symbols,
many repeated lines, odd word lengths. Failures are counted by host (the ``source`` of a document), and the failure rates
are shrunk towards a beta prior fitted to all hosts by moments. A host is judged by what its posterior leaves little doubt
of: by the lower ``TAIL`` quantile of its failure rate (normal approximation of the beta posterior, whose deviation falls
with the host's documents). So a small host needs no rule of its own: it needs a higher raw rate than a large one for the
same verdict. The verdict goes back to the documents: a *bad* host (quantile above ``max_rate``) loses them all, a
*doubtful* one (above the mean of the prior) those that fail any rule, a *good* one those that fail a base rule.

Repeated 3-word windows are found inside each row: the windows' 64-bit hashes are sorted with their positions, equal
neighbours are repeats. No window leaves its row, so nothing but one short row per document is shuffled.

Defined results: null or empty text has no words and fails the base rules; a null source is a host of its own; with
no host at all the result is empty; repeated rows count repeatedly; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.sources.tables import staged

MIN_WORDS = 50
#: Symbols a word.
MAX_SYMBOLS = 0.1
#: Repeated lines, of the lines with a word.
MAX_DUP_LINES = 0.3
#: Code points a word.
WORD_LENGTHS = (2.5, 12.0)
MAX_RATE = 0.5
#: Deviations below the posterior's mean at which a host is judged: the lower 5 % quantile.
TAIL = 1.645
WORD = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once for the row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, source, n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words; one row per document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = docs.select("doc_id", "source", text.alias("t"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    windows = F.when(
        F.size("w") >= 4,
        F.transform(
            F.sequence(F.lit(0), F.size("w") - 3),
            lambda i: F.struct(F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).alias("h"), i.alias("i")),
        ),
    )
    sorted_windows = words.select(
        "doc_id",
        "source",
        F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.struct(F.size(x).alias("all"), F.size(F.array_distinct(x)).alias("once"))).alias("l"),
        F.sort_array(windows).alias("s"),
    )
    repeated = F.filter(
        F.zip_with("s", F.slice("s", 2, F.size("s")), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))), lambda x: x.isNotNull()
    )
    covered = let(
        F.sort_array(F.array_distinct(F.flatten(repeated))),
        lambda at: F.aggregate(
            F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(F.lit(3), F.coalesce(b - a, F.lit(3)))),
            F.lit(0).cast("long"),
            lambda n, x: n + x,
        ),
    )
    return sorted_windows.select(
        "doc_id", "source", "n_words", "word_chars", "n_symbols", F.col("l.all").cast("long").alias("n_lines"), (F.col("l.all") - F.col("l.once")).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rule_failed() -> Column:
    """Fails any rule: the base ones, many symbols, many repeated lines, odd word lengths."""
    return (
        base_failed()
        | (F.col("n_symbols") > MAX_SYMBOLS * F.col("n_words"))
        | (F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))
        | (F.col("word_chars") < WORD_LENGTHS[0] * F.col("n_words"))
        | (F.col("word_chars") > WORD_LENGTHS[1] * F.col("n_words"))
    )


def host_verdicts(measures: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: source, host_docs, host_failed, host_rate (shrunk), host_least (its lower quantile), host_verdict (good, doubtful or bad).

    The prior is two numbers from one row of moments.
    """
    hosts = measures.groupBy("source").agg(F.count(F.lit(1)).alias("host_docs"), F.count_if(rule_failed()).alias("host_failed"))
    rate = F.col("host_failed") / F.col("host_docs")
    m = hosts.agg(
        F.sum("host_failed").alias("f"), F.sum("host_docs").alias("n"), F.count(F.lit(1)).alias("k"),
        F.var_pop(rate).alias("v"), F.avg(1 / F.col("host_docs")).alias("inv"),
    ).first()
    if not m["k"]:
        return hosts.withColumns({"host_rate": F.lit(0.0), "host_least": F.lit(0.0), "host_verdict": F.lit("good")})
    mean = m["f"] / m["n"]
    noise = mean * (1 - mean) * m["inv"]
    between = max(m["v"] - noise, 1e-9)
    strength = min(max(mean * (1 - mean) / between - 1, 1.0), 1e6)
    shrunk = (F.col("host_failed") + F.lit(mean * strength)) / (F.col("host_docs") + F.lit(strength))
    spread = F.sqrt(F.col("host_rate") * (1 - F.col("host_rate")) / (F.col("host_docs") + F.lit(strength + 1.0)))
    verdict = F.when(F.col("host_least") > max_rate, "bad").when(F.col("host_least") > mean, "doubtful").otherwise("good")
    return hosts.withColumn("host_rate", shrunk).withColumn("host_least", F.col("host_rate") - TAIL * spread).withColumn("host_verdict", verdict)


def judge(docs: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per document: its measures, base_failed, kept, and the shrunk failure rate and verdict of its host."""
    measures = staged(measure(docs), "quality")
    hosts = host_verdicts(measures, max_rate).select(F.col("source").alias("__host"), "host_rate", "host_verdict")
    verdict = F.col("host_verdict")
    return (
        measures.join(hosts, F.col("source").eqNullSafe(F.col("__host")), "left")
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (verdict != "bad") & ~(rule_failed() & (verdict == "doubtful")))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rate", "host_verdict",
        )
    )
