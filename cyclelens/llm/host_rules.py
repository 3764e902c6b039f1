"""Quality rules that judge hosts, with DataFrame functions only.

Each document is measured and held against four rules (too few words, repeated windows,
symbols, repeated lines). Failures are counted for every host by partial sums, so a host
with a third of all rows sends one row per task. A host's failure rate is shrunk towards
that of all hosts by a beta prior whose strength is estimated from the spread of the
hosts' rates (method of moments, less the spread that sampling alone would give): a host
of three documents is not condemned by two bad ones. A host is rejected when the shrunk
rate of a rule exceeds `HOST_LIMIT`, and the verdict is joined back to its documents.

Equality of eight-word windows within a text is decided by 64-bit hashes of them.

A null text has no words and so fails by itself. A document with a null host has no host
verdict and is judged by its own measures. Repeated rows count as often as they occur;
null ids are carried along; an empty table gives an empty result. Only the named columns
are read, so further columns of any name do no harm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cyclelens.llm.native import indices, let, words_of
from cyclelens.session import written

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
SYMBOL_PERCENT = 10  # symbols for each hundred words
LINE_PERCENT = 30
HOST_LIMIT = 0.5
_STRENGTH = (1.0, 1e6)  # least and most rows that the prior counts for

_SYMBOL = r"[#*$%&|<>]"
RULES = ("short", "repeats", "symbols", "lines")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words in windows that occur twice or more in the text."""

    def covered(sums: Column) -> Column:
        tagged = F.array_sort(F.transform(sums, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))

        def starts(by_sum: Column) -> Column:
            def same(at: Column, s: Column) -> Column:
                return F.coalesce(F.get(by_sum, at)["x"] == s["x"], F.lit(False))

            again = F.filter(by_sum, lambda s, j: same(j - 1, s) | same(j + 1, s))
            return F.array_sort(F.transform(again, lambda s: s["i"]))

        def step(done: Column, at: Column) -> Column:
            more = F.least(F.lit(window), at - done["last"])
            return F.struct(at.alias("last"), (done["n"] + more).alias("n"))

        first = F.struct(F.lit(-window).alias("last"), F.lit(0).alias("n"))
        return let(tagged, lambda s: F.aggregate(starts(s), first, step, lambda done: done["n"]))

    def count(hashes: Column) -> Column:
        sums = F.transform(
            indices(F.size(hashes) - window + 1),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]),
        )
        return let(sums, lambda x: F.when(F.size(F.array_distinct(x)) == F.size(x), F.lit(0)).otherwise(covered(x)))

    return let(F.transform(words, lambda w: F.xxhash64(w)), count)


def measures(text: Column) -> Column:
    """Struct of the counts that the rules need, as longs."""
    has_word = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))

    def of(words: Column, lines: Column) -> Column:
        counts = {
            "n_words": F.size(words),
            "word_chars": F.length(F.array_join(words, "")),
            "n_symbols": F.coalesce(F.regexp_count(text, F.lit(_SYMBOL)), F.lit(0)),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": repeated_words(words),
            "n_lines": F.size(lines),
        }
        return F.struct(*[n.cast("long").alias(name) for name, n in counts.items()])

    lines = F.coalesce(has_word, F.array().cast("array<string>"))
    return let(words_of(text), lambda w: let(lines, lambda x: of(w, x)))


def failures() -> dict[str, Column]:
    """Rule -> whether a measured document fails it."""
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": F.col("n_repeat_words") * 100 > n * REPEAT_PERCENT,
        "symbols": F.col("n_symbols") * 100 > n * SYMBOL_PERCENT,
        "lines": F.col("n_dup_lines") * 100 > F.col("n_lines") * LINE_PERCENT,
    }


def host_rates(measured: DataFrame) -> DataFrame:
    """Per `host`: `n_docs` and, for each rule, the shrunk failure rate `rate_<rule>`."""
    failed = failures()
    hosts = measured.where("host is not null").groupBy("host").agg(
        F.count("*").alias("n_docs"),
        *[F.count_if(failed[r]).alias(f"failed_{r}") for r in RULES],
    )
    n = F.col("n_docs")
    sums = [F.sum(f"failed_{r}").alias(f"sum_{r}") for r in RULES]
    squares = [F.sum(F.col(f"failed_{r}") * F.col(f"failed_{r}") / n).alias(f"square_{r}") for r in RULES]
    every = hosts.agg(F.count("*").alias("hosts"), F.sum("n_docs").alias("docs"), *sums, *squares).first()
    rates = []
    for rule in RULES:
        mean, strength = prior(every["hosts"], every["docs"], every[f"sum_{rule}"], every[f"square_{rule}"])
        rates.append(((F.col(f"failed_{rule}") + strength * mean) / (n + strength)).alias(f"rate_{rule}"))
    return hosts.select("host", "n_docs", *rates)


def prior(hosts: int, docs: int | None, failed: int | None, squares: float | None) -> tuple[float, float]:
    """Mean of the beta prior and the number of rows that it counts for.

    `squares` is the sum of failed^2 / rows over the hosts. The spread of the hosts'
    rates, less what sampling alone would give, is the spread of the prior."""
    if not docs:
        return 0.0, _STRENGTH[0]
    mean = failed / docs
    alone = mean * (1 - mean)
    spread = squares / docs - mean * mean - alone * hosts / docs
    strength = alone / spread - 1 if spread > 0 else _STRENGTH[1]
    return mean, min(max(strength, _STRENGTH[0]), _STRENGTH[1])


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """`row_id`, the measures, `base_failed`, `host_failed` and `kept` for every row."""
    text = F.col(text_col).cast("string")
    measured = df.select(
        F.col(id_col).alias("row_id"), F.col(host_col).cast("string").alias("host"),
        F.inline(F.array(measures(text))),
    )
    measured = written(measured, "host-measures")
    rates = host_rates(measured)
    failed_hosts = rates.select(
        "host", F.greatest(*[F.col(f"rate_{r}") for r in RULES]).alias("rate")
    ).where(F.col("rate") > HOST_LIMIT).select("host", F.lit(True).alias("bad"))
    failed = failures()
    # A plain join: the engine broadcasts the rejected hosts when their measured size is
    # small, and splits a host with very many documents when it is not.
    joined = measured.join(failed_hosts, "host", "left")
    base_failed, host_failed = failed["short"] | failed["repeats"], F.coalesce("bad", F.lit(False))
    return joined.select(
        "row_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), host_failed.alias("host_failed"),
        (~base_failed & ~host_failed).alias("kept"),
    )
