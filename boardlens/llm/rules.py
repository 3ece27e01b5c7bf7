"""Quality rules: a decision list learnt by sequential covering, as ordered Spark conditions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import labelled
from boardlens.llm.textstats import FEATURES
from boardlens.operators.lineage import cut

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
THRESHOLDS = 48  # candidate cuts of a statistic, at its quantiles
QUANTILE_ERROR = 0.002
MAX_CONDITIONS = 3  # of a rule, which stays readable
MIN_PRECISION = 0.9  # estimated, of a rejecting rule
PRIOR_ROWS = 2  # rows that the growing rows' share of rejects counts as among the pruning rows


@dataclass(frozen=True)
class Condition:
    """``stat > cut`` if ``above``, else ``stat <= cut``."""

    stat: str
    above: bool
    cut: float

    def column(self, stats: str) -> Column:
        value = F.col(stats)[self.stat]
        return value > self.cut if self.above else value <= self.cut

    def __str__(self) -> str:
        return f"{self.stat} {'>' if self.above else '<='} {self.cut:.6g}"


Rule = tuple[Condition, ...]  # a conjunction; a row that fulfils it is rejected


def _all(rule: Rule, stats: str) -> Column:
    out = F.lit(True)
    for c in rule:
        out = out & c.column(stats)
    return out


def base_failed(stats: str = "stats") -> Column:
    """Fewer than MIN_WORDS words, or more than MAX_REPEAT_PERCENT percent of the words in repeated windows."""
    s = F.col(stats)
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


def verdict(rules: list[Rule], stats: str = "stats") -> Column:
    """False for a row that fails the base or that the first matching rule rejects, else true."""
    out = F.when(base_failed(stats), F.lit(False))
    for rule in rules:
        out = out.when(_all(rule, stats), F.lit(False))
    return out.otherwise(F.lit(True))


def _cuts_below(value: Column, cuts: list[float]) -> Column:
    return F.size(F.filter(F.lit(cuts), lambda c: c < value))


def _histograms(rows: DataFrame, cuts: dict[str, list[float]]) -> dict[str, np.ndarray]:
    """Per statistic, (rejected, kept) rows by the number of cuts below the value; one row per bin reaches the driver."""
    found = rows.select("bad", F.posexplode("bins").alias("stat", "bin")).groupBy("stat", "bin").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n"))
    out = {n: np.zeros((2, len(c) + 1)) for n, c in cuts.items()}
    names = list(cuts)
    for r in found.collect():
        out[names[r.stat]][:, r.bin] = r.bad, r.n - r.bad
    return out


def _best(hist: dict[str, np.ndarray], cuts: dict[str, list[float]], bad: float, good: float) -> tuple[float, Condition] | None:
    """The condition with the largest information gain weighted by the rejected rows it covers."""
    base = np.log2(bad / (bad + good))
    best = None
    for name, h in hist.items():
        below = np.cumsum(h, axis=1)[:, :-1]
        for above, (p, n) in ((False, below), (True, h.sum(axis=1, keepdims=True) - below)):
            gain = np.where(p >= 1, p * (np.log2(np.maximum(p, 1e-9) / np.maximum(p + n, 1e-9)) - base), -1.0)
            k = len(gain) - 1 - int(gain[::-1].argmax()) if above else int(gain.argmax())  # of equals, the one that covers least
            if best is None or gain[k] > best[0]:
                best = float(gain[k]), Condition(name, above, cuts[name][k])
    return best


def learn_rules(stats: DataFrame, labels: DataFrame, label: str = "quality") -> list[Rule]:
    """Rejecting rules from every labelled row of ``stats`` (doc_id, stats struct) that is not held out and passes the base.

    Two thirds of the rows, by a hash of the id, grow a rule condition by condition, up to MAX_CONDITIONS; the other third prunes it
    to the prefix with the best estimated precision and ends the search when no prefix reaches MIN_PRECISION. The estimate
    is the rejects' share among the pruning rows a prefix covers, with the (Laplace corrected) share among the growing rows
    counting as PRIOR_ROWS more of them: few labels can still carry a rule, and no number of rows is required.
    Rows covered by a rule leave both sets, so the list ends by itself. Labels of 0.5 and more count as kept.
    No labelled row, or rows of one class only, give an empty list.
    """
    rows = labelled(stats, labels.select("doc_id", label), label).filter(~base_failed()).select(
        "stats", (F.col("label") < 0.5).cast("int").alias("bad"), (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prunes")
    )
    rows = cut(rows)
    points = [i / (THRESHOLDS + 1) for i in range(1, THRESHOLDS + 1)]
    quantiles = rows.select(*[F.col(f"stats.{n}").alias(n) for n in FEATURES]).approxQuantile(FEATURES, points, QUANTILE_ERROR)
    bad_quantiles = rows.filter("bad = 1").select(*[F.col(f"stats.{n}").alias(n) for n in FEATURES]).approxQuantile(FEATURES, points, QUANTILE_ERROR)
    cuts = {n: sorted({float(x) for x in [*q, *b]}) for n, q, b in zip(FEATURES, quantiles, bad_quantiles, strict=True)}
    cuts = {n: c for n, c in cuts.items() if c}
    if cuts:
        rows = cut(rows.withColumn("bins", F.array(*[_cuts_below(F.col(f"stats.{n}"), c) for n, c in cuts.items()])))
        grow, prune = rows.filter("not prunes"), rows.filter("prunes")
    rules: list[Rule] = []
    while cuts:
        open_grow, open_prune = grow, prune
        for r in rules:
            open_grow, open_prune = open_grow.filter(~_all(r, "stats")), open_prune.filter(~_all(r, "stats"))
        rule: Rule = ()
        while len(rule) < MAX_CONDITIONS:
            hist = _histograms(open_grow.filter(_all(rule, "stats")), cuts)
            bad, good = next(iter(hist.values())).sum(axis=1)
            if bad == 0 or good == 0:
                break
            best = _best(hist, cuts, bad, good)
            if best is None or best[0] <= 0:
                break
            rule = (*rule, best[1])
        if not rule:
            break
        parts = [rule[: i + 1] for i in range(len(rule))]
        tests = [f(F.when(_all(p, "stats") & (F.col("prunes") if last else ~F.col("prunes")), v)) for p in parts for last in (False, True) for f, v in ((F.sum, F.col("bad")), (F.count, F.lit(1)))]
        counts = [x or 0 for x in open_grow.unionByName(open_prune).agg(*tests).first()]
        worth = []
        for i, part in enumerate(parts):
            grown_bad, grown, bad, n = counts[4 * i : 4 * i + 4]
            worth.append(((bad + PRIOR_ROWS * (grown_bad + 1) / (grown + 2)) / (n + PRIOR_ROWS), part))
        precision, kept = max(worth, key=lambda w: (w[0], -len(w[1])))
        if precision < MIN_PRECISION:
            break
        rules.append(kept)
    return rules
