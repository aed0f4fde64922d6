"""URL filters: rules for hosts and paths, and reputations of hosts.

A url that fits a rule gets the verdict of the longest rule.  The others are
judged by the reputation of their host: the share that rules block of its pages that
fit a rule, shrunk by beta-binomial priors from the host to its registered domain, to
its suffix, to all pages.  Pages that no rule fits have no outcome and do not count; a
host without others has the prior of its domain.  Where the domain has no page with an
outcome either, nothing is known and nothing blocked.

The limit that the lower bound of a reputation must pass is chosen on held-out pages:
those that fit a rule and whose url has a low digest.  Reputations of the others judge
them, and of ``LIMITS`` the one with most right verdicts is taken, of equal ones the
highest, which blocks least.  Then all pages with an outcome count.  Only DataFrame
functions are used.

Defined results: a null url or one without ``://`` has empty host and path, and
fits no rule; repeated rows count as often as they occur; an empty table gives
an empty result; input columns named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence
from string import ascii_lowercase, ascii_uppercase
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from recueil.llm.common import small, stored


class Rule(NamedTuple):
    """Fits its host and all subdomains if the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [
    Rule("block", "net"), Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/"),
]

#: Suffixes of two labels below which domains are registered; others have one.
LONG_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz"]

#: Limits to choose from; a host is blocked if its posterior mean less ``BOUND``
#: deviations passes the limit.
LIMITS = [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]
BOUND = 1.0

#: Urls whose MD5 begins with a digit below this are held out.
HELD_OUT = "3"

_PARTS = "://([^/?#]*)([^?#]*)"


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` (A-Z lower-cased) and ``path``."""
    address = F.coalesce(F.col(f"`{url}`"), F.lit(""))
    host = F.translate(F.regexp_extract(address, _PARTS, 1), ascii_uppercase, ascii_lowercase)
    both = pages.select("*", F.struct(host.alias("host"), F.regexp_extract(address, _PARTS, 2).alias("path")).alias("__url"))
    return both.withColumns({"host": F.col("__url.host"), "path": F.col("__url.path")}).drop("__url")


def longest_rule(rules: Sequence[Rule], value: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, else null.

    For a hand-kept list: the rules become one expression.  Of rules with equal
    length the first in the list wins.
    """
    found = F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):
        host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
        found = F.when(host & F.col("path").startswith(rule.path), F.lit(getattr(rule, value))).otherwise(found)
    return found


def _registered(long_suffixes: Sequence[str]) -> dict[str, Column]:
    labels = F.split("host", r"\.")
    n = F.when(F.substring_index("host", ".", -2).isin(list(long_suffixes)), 2).otherwise(1)
    return {
        "suffix": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), n)),
        "domain": F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - n, F.lit(1)), n + 1)),
    }


def reputations(outcomes: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES, bound: float = BOUND) -> DataFrame:
    """``host, n, k, reputation, low`` from pages with ``host`` and ``bad``.

    Pages whose ``bad`` is null do not count; a host without others has the
    posterior of its domain as prior and nothing else.

    On each level the groups' rates around their parent's posterior mean give,
    by moments, the strength of the prior; the child's posterior follows.
    ``low`` is the posterior mean of a host less ``bound`` deviations, 0 if the
    whole domain has no page that counts.
    """
    counts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.count_if("bad").alias("k"))
    hosts = stored(counts.withColumns(_registered(long_suffixes)), "url_hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    parents, up = None, []
    for keys in (["suffix"], ["suffix", "domain"], ["suffix", "domain", "host"]):
        groups = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        if parents is None:
            groups = groups.withColumn("mean", F.lit(((total["k"] or 0) + 0.5) / ((total["n"] or 0) + 1.0)))
        else:
            groups = groups.join(small(parents), up)  # adds mean and above
        groups = stored(groups, "url_level")
        chance = F.col("mean") * (1 - F.col("mean"))
        spread = groups.filter("n > 0").agg(
            F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("mean"), 2) - chance).alias("more"),
            F.sum((F.col("n") - 1) * chance).alias("free"),
        ).first()
        rho = spread["more"] / spread["free"] if spread["free"] else 0.5
        strength = 1 / min(max(rho, 0.001), 0.9) - 1
        alpha = F.col("k") + F.col("mean") * strength
        beta = F.col("n") - F.col("k") + (1 - F.col("mean")) * strength
        shrunk = groups.withColumns({"alpha": alpha, "beta": beta})
        posterior = (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("mean")
        parents, up = stored(shrunk.select(*keys, posterior, F.col("n").alias("above")), "url_prior"), keys
    weight = F.col("alpha") + F.col("beta")
    mean = F.col("alpha") / weight
    deviation = F.sqrt(mean * (1 - mean) / (weight + 1))
    low = F.when(F.col("above") > 0, mean - bound * deviation).otherwise(0.0)
    return shrunk.select("host", "n", "k", mean.alias("reputation"), low.alias("low"))


def chosen_limit(outcomes: DataFrame, limits: Sequence[float] = LIMITS, bound: float = BOUND) -> float:
    """The limit with most right verdicts on held-out pages; the highest without any.

    ``outcomes`` has ``host, bad, held``.
    """
    fitted = reputations(outcomes.withColumn("bad", F.when(~F.col("held"), F.col("bad"))), bound=bound).select("host", "low")
    held = outcomes.filter("held").groupBy("host").agg(F.count("bad").alias("n"), F.count_if("bad").alias("k")).filter("n > 0")
    right = [F.sum(F.when(F.col("low") > x, F.col("k")).otherwise(F.col("n") - F.col("k"))) for x in limits]
    counts = held.join(fitted, "host").agg(*[x.alias(f"at_{i}") for i, x in enumerate(right)]).first()
    return max(zip([x or 0 for x in counts], limits, strict=True))[1]


def judged(
    pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", limits: Sequence[float] = LIMITS, bound: float = BOUND,
) -> DataFrame:
    """Adds ``host, path, rule, verdict`` to every page."""
    ruled = with_parts(pages, url).withColumns(
        {"rule": longest_rule(rules, "name"), "verdict": longest_rule(rules, "verdict")}
    )
    digest = F.md5(F.coalesce(F.col(f"`{url}`"), F.lit("")))
    outcomes = stored(
        ruled.select("host", (F.col("verdict") == "block").alias("bad"), (F.substring(digest, 1, 1) < HELD_OUT).alias("held")), "url_outcomes"
    )
    limit = chosen_limit(outcomes, limits, bound)
    blocked = stored(
        reputations(outcomes, bound=bound).filter(F.col("low") > limit).select(F.col("host").alias("__host")), "url_blocked"
    )
    joined = ruled.join(small(blocked), F.col("host") == F.col("__host"), "left")
    own = F.when(F.col("__host").isNotNull(), "block").otherwise("allow")
    return joined.withColumn("verdict", F.coalesce("verdict", own)).drop("__host")
