"""Mixing to target weights by soft membership.

A classifier trained from a labelled table gives each document posteriors over domains; nonnegative rates per document are
fitted so that the expected tokens of each domain meet the targets: least squares over (tokens x posterior), by a projected
gradient step whose length in each domain is fitted. Only built-in DataFrame functions; a try sums a few numbers per domain
over all documents, and only those sums reach the driver.
"""

from __future__ import annotations

import math
import warnings

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, words, written

BUCKETS = 4096
#: Share of the budget by which a domain may miss its target.
UNMET = 1e-3
#: Weight of pulls in a fit, relative to the largest domain's sum of squares: what it leaves unmet is far below UNMET.
RIDGE = 1e-10
#: Lengths of a step that are tried at most; each is shorter by a factor of up to 10.
TRIES = 40


def _ids(text: str) -> Column:
    """Bucket numbers of the words."""
    return F.transform(words(F.lower(F.coalesce(F.col(text), F.lit("")))), lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def fit_domains(labelled: DataFrame, domains: list[str], text: str = "text", domain: str = "domain") -> dict[str, list[float]]:
    """Log probabilities of the word buckets in each domain (naive Bayes, add one), from rows of text and domain.

    Rows of other or null domains count nothing; a domain without rows is uniform.
    """
    counts = labelled.filter(F.col(domain).isin(domains)).select(domain, F.explode(_ids(text)).alias("b")).groupBy(domain, "b").agg(F.count(F.lit(1)).alias("n"))
    n = {d: [1.0] * BUCKETS for d in domains}
    for row in counts.collect():  # at most domains x BUCKETS rows
        n[row[domain]][row["b"]] += row["n"]
    return {d: [math.log(x / sum(v)) for x in v] for d, v in n.items()}


def posteriors(docs: DataFrame, model: dict[str, list[float]], out: str = "p", tokens: str = "n_tokens", text: str = "text", strength: float = 8.0) -> DataFrame:
    """docs with tokens (the number of words) and out (an array of posteriors in the order of the model's domains).

    The mean log probability of a word counts as strength words do, or as the words there are if fewer, so that long
    documents keep soft memberships. A text without words has equal posteriors.
    """
    ids, logs, exps = (free_name(docs, f"_{n}") for n in ("ids", "logs", "exps"))
    df = docs.withColumn(ids, _ids(text)).withColumn(tokens, F.size(ids).cast("long"))
    weights = [F.split(F.lit(",".join(f"{x:.6g}" for x in v)), ",").cast("array<double>") for v in model.values()]
    total = lambda w: F.aggregate(ids, F.lit(0.0), lambda a, i: a + F.get(w, i))
    df = df.withColumn(logs, F.array(*[F.coalesce(F.try_divide(total(w), F.col(tokens)) * F.least(F.col(tokens), F.lit(strength)), F.lit(0.0)) for w in weights]))
    df = df.withColumn(exps, F.transform(logs, lambda x: F.exp(x - F.array_max(logs))))
    return df.withColumn(out, F.transform(exps, lambda x: x / F.aggregate(exps, F.lit(0.0), lambda a, y: a + y))).drop(ids, logs, exps)


def fit_rates(df: DataFrame, targets: list[float], p: str = "p", tokens: str = "n_tokens", *, start: float = 1.0, steps: int = 100, tolerance: float = 1e-6) -> tuple[Column, list[float]]:
    """The rate of a row as an expression over p and tokens, and the domain totals it gives.

    Minimises the squared distance of domain totals from targets over rates of zero or more, of such rates those nearest to
    start. They are start less one gradient step, projected: max(0, start - share . pull), with a pull for each domain. The
    pulls are the least of a convex function of as many numbers as domains (its slope is what targets are missed by, and
    RIDGE times the pull, which keeps pulls finite where targets can't be met), found by Newton steps over the rows whose
    rate isn't zero; a step is shortened until the slope along it is no longer steeply uphill, so each comes nearer. Ends
    when every total is within tolerance of its target (relative to the largest), or when the slope is gone: then what is
    left is unmet because the documents can't serve it. Of n domains each try sums n (n + 3) / 2 numbers over all rows. A fit
    that ends in neither way in so many steps gives the rates so far, and a warning.
    """
    n = len(targets)
    share = [F.col(tokens) * F.get(p, F.lit(d)) for d in range(n)]
    pairs = [(i, j) for i in range(n) for j in range(i, n)]

    def told(pulls: np.ndarray) -> tuple[Column, np.ndarray, np.ndarray]:
        """The rate that pulls give, its totals, and the domains' products over the rows whose rate isn't zero."""
        g = F.split(F.lit(",".join(repr(float(x)) for x in pulls)), ",").cast("array<double>")
        rate = F.greatest(F.lit(0.0), start - sum(share[d] * F.get(g, F.lit(d)) for d in range(n)))
        rows = df.withColumn("_rate", rate).withColumn("_on", (F.col("_rate") > 0).cast("double"))
        row = rows.agg(*[F.sum(F.col("_rate") * share[d]).alias(f"t{d}") for d in range(n)], *[F.sum(F.col("_on") * share[i] * share[j]).alias(f"m{i}_{j}") for i, j in pairs]).first()
        products = np.array([[row[f"m{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(n)] for i in range(n)])
        return rate, np.array([row[f"t{d}"] or 0.0 for d in range(n)]), products

    target, near = np.array(targets, float), tolerance * max(targets, default=1.0)
    pulls = np.zeros(n)
    rate, totals, products = told(pulls)
    scale = np.sqrt(np.diag(products)) + (np.diag(products) == 0)  # pulls are scaled, so that rare domains move as others do
    ridge = RIDGE * float(max(scale, default=1.0)) ** 2 / scale**2
    slope = lambda totals, pulls: (target - totals) / scale + ridge * pulls * scale
    for _ in range(steps):
        uphill = slope(totals, pulls)
        if (abs(totals - target) <= near).all() or (abs(uphill * scale) <= near).all():
            return rate, totals.tolist()
        step = -np.linalg.solve(products / np.outer(scale, scale) + np.diag(ridge), uphill)
        first, length = float(uphill @ step), 1.0
        for _ in range(TRIES):
            tried = pulls + length * step / scale
            new = told(tried)
            along = float(slope(new[1], tried) @ step)
            if along <= -0.5 * first:
                break
            length = max(length * first / (first - along), 0.1 * length)
        pulls, (rate, totals, products) = tried, new
    warnings.warn(f"rates don't settle in {steps} steps: totals {totals.tolist()}, targets {targets}", stacklevel=2)
    return rate, totals.tolist()


def mix(docs: DataFrame, model: dict[str, list[float]], weights: dict[str, float], budget: float | None = None, text: str = "text", seed: int = 5) -> DataFrame:
    """docs with n_tokens, p (posteriors in the order of weights), rate and copies.

    weights are the domains' shares of the tokens drawn (scaled to sum to one); budget is their number, by default the
    least at which no domain is drawn less than once, so nothing is lost. copies is the rate rounded up or down by a hash of
    the row's columns, so its expectation over hashes is the rate. Rows alike in all columns get the same rate and copies.
    Targets that the rates miss by over UNMET of the budget (no document can serve them, say) are told by a warning.
    Null and empty texts have no tokens, equal posteriors and the starting rate 1. An empty table gives no rows. Columns
    with the names above are replaced.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ("n_tokens", "p", "rate", "copies")])
    model = {d: model[d] for d in weights}
    df = written(posteriors(docs, model, text=text))
    row = df.agg(*[F.sum(F.col("n_tokens") * F.get("p", F.lit(k))).alias(f"t{k}") for k in range(len(weights))]).first()
    now, whole = [row[f"t{k}"] or 0.0 for k in range(len(weights))], sum(weights.values())
    share = [w / whole for w in weights.values()]
    budget = budget or max([t / s for t, s in zip(now, share, strict=True) if s > 0], default=0.0)
    targets = [budget * s for s in share]
    rate, totals = fit_rates(df, targets)
    unmet = {d: (t, x) for d, t, x in zip(weights, targets, totals, strict=True) if abs(t - x) > UNMET * max(budget, 1.0)}
    if unmet:
        warnings.warn(f"targets that the fitted rates don't meet (target, expected tokens): {unmet}", stacklevel=2)
    df = df.withColumn("rate", rate)
    unit = F.pmod(F.xxhash64(F.lit(seed), *docs.columns), F.lit(1 << 30)) / float(1 << 30)
    return df.withColumn("copies", F.floor(F.col("rate") + unit).cast("int"))
