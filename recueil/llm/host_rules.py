"""Quality rules per document and, by shrunk failure rates, per host.

Every document is measured from its whole text.  The documents of a host that
fail a rule are counted, the rate is shrunk with a beta prior fitted to all
hosts, and a host whose rate is surely high loses all its documents.  Only
DataFrame functions are used.

Defined results: a null text has no words, so it fails the base rules; a null
host is a host of its own; repeated rows count as often as they occur; an empty
table gives an empty result; columns of the input that bear the name of a
measure are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recueil.llm.common import SPACE, WORD, held, small, stored, whole_text

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SYMBOLS = "[#*$%&|<>]+"

#: Documents with fewer words fail, and those of which more than this share
#: (per cent) of the words stands in repeated three-word windows.
MIN_WORDS = 50
MAX_REPEATED = 50

#: A host is rejected if the lower bound of its shrunk rate passes the limit.
HOST_LIMIT = 0.5
BOUND = 2.0


def _repeated_words(docs: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` from the column ``__words``.

    Windows are compared by 64-bit hashes within one document.
    """
    n = F.size("__words")
    coded = held(docs, "__codes", F.transform("__words", lambda w: F.xxhash64(w)))

    def window(i: Column) -> Column:
        parts = [F.get("__codes", i + k) for k in range(3)]
        return F.struct(F.xxhash64(*parts).alias("h"), i.alias("i"))

    none = F.array().cast("array<struct<h:bigint,i:int>>")
    windows = F.when(n >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), window))).otherwise(none)
    ordered = held(coded, "__windows", windows)

    # Sorted by hash, equal windows are neighbours.
    def covered(a: Column, b: Column) -> Column:
        return F.when(a["h"] == b["h"], F.array(*[x["i"] + k for x in (a, b) for k in range(3)]))

    after = F.slice("__windows", F.lit(2), F.greatest(F.size("__windows") - 1, F.lit(0)))
    places = F.flatten(F.filter(F.zip_with("__windows", after, covered), lambda x: x.isNotNull()))
    counted = F.size(F.array_distinct(places)).cast("bigint")
    return ordered.withColumn("n_repeat_words", counted).drop("__codes", "__windows")


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measures and ``base_failed`` to every document."""
    value = whole_text(text)
    words = held(docs, "__words", F.array_remove(F.split(value, SPACE + "+"), ""))
    lines = held(words, "__lines", F.filter(F.split(value, "\n"), lambda x: x.rlike(WORD)))
    counted = _repeated_words(lines).withColumns({
        "n_words": F.size("__words").cast("bigint"),
        "word_chars": F.length(F.array_join("__words", "")).cast("bigint"),
        "n_symbols": (F.length(value) - F.length(F.regexp_replace(value, SYMBOLS, ""))).cast("bigint"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("bigint"),
    })
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return counted.drop("__words", "__lines").withColumn("base_failed", failed)


def failures() -> dict[str, Column]:
    """The rules that are counted per host, as conditions on the measures."""
    words = F.col("n_words")
    return {
        "short": words < MIN_WORDS,
        "repeats": 100 * F.col("n_repeat_words") > MAX_REPEATED * words,
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "lines": 5 * F.col("n_dup_lines") > words,
        "word_length": (F.col("word_chars") < 2 * words) | (F.col("word_chars") > 12 * words),
    }


def host_verdicts(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT, bound: float = BOUND) -> DataFrame:
    """One row per host: documents, shrunk rate per rule and ``rejected``.

    ``docs`` has the measures.  For each rule, the rates of all hosts give a
    beta prior (mean and, by moments, strength); the posterior mean minus
    ``bound`` standard deviations is compared with ``limit``.
    """
    rules = failures()
    counts = docs.groupBy(F.col(f"`{host}`").alias("host")).agg(
        F.count("*").alias("docs"), *[F.count_if(rule).alias(f"k_{name}") for name, rule in rules.items()]
    )
    hosts = stored(counts, "hosts")
    n = F.col("docs")
    total = hosts.agg(F.sum("docs").alias("n"), *[F.sum(f"k_{x}").alias(x) for x in rules]).first()
    mean = {x: ((total[x] or 0) + 0.5) / ((total["n"] or 0) + 1.0) for x in rules}
    # Beta-binomial moments: the spread of the rates beyond what counts of this
    # size have by chance gives the correlation within hosts.
    spread = hosts.agg(
        F.sum(n - 1).alias("free"),
        F.count("*").alias("hosts"),
        *[F.sum(n * F.pow(F.col(f"k_{x}") / n - mean[x], 2)).alias(x) for x in rules],
    ).first()
    rates, bad = [], []
    for x in rules:
        chance = mean[x] * (1 - mean[x])
        free = chance * (spread["free"] or 0)
        rho = ((spread[x] or 0.0) - chance * spread["hosts"]) / free if free else 0.5
        rho = min(max(rho, 0.001), 0.9)
        strength = 1 / rho - 1
        alpha, beta = F.col(f"k_{x}") + mean[x] * strength, n - F.col(f"k_{x}") + (1 - mean[x]) * strength
        rate = alpha / (alpha + beta)
        deviation = F.sqrt(alpha * beta / (F.pow(alpha + beta, 2) * (alpha + beta + 1)))
        rates.append(rate.alias(f"rate_{x}"))
        bad.append(rate - bound * deviation > limit)
    rejected = bad[0]
    for x in bad[1:]:
        rejected = rejected | x
    return hosts.select("host", "docs", *rates, rejected.alias("rejected"))


def judged(docs: DataFrame, verdicts: DataFrame, host: str = "source") -> DataFrame:
    """Adds ``kept``: no base rule failed and the host is not rejected.

    Only the rejected hosts are joined.
    """
    rejected = stored(verdicts.filter("rejected").select(F.col("host").alias("__host")), "rejected_hosts")
    marked = rejected.select("__host", F.lit(True).alias("__bad"))
    joined = docs.join(small(marked), F.col(f"`{host}`").eqNullSafe(F.col("__host")), "left")
    return joined.withColumn("kept", ~F.col("base_failed") & F.col("__bad").isNull()).drop("__host", "__bad")


def quality_rules(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """All documents with measures, ``base_failed`` and ``kept``; texts are
    measured twice, because they are not stored."""
    counted = measured(docs, text)
    return judged(counted, host_verdicts(counted, host), host)


def quality_table(docs: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The verdict table without texts: key, measures, ``base_failed, kept``."""
    counted = stored(measured(docs, text).select(key, F.col(f"`{host}`").alias("host"), *MEASURES, "base_failed"), "measures")
    return judged(counted, host_verdicts(counted, "host"), "host").drop("host")
