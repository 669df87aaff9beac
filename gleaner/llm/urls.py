"""URL filters: host and path rules, and gradient-boosted trees for the URLs that no rule fits.

The trees see lexical features only: lengths, depth, digit ratio, character entropy, parameter count
and the block rates of the host's suffixes among labelled URLs. They are fitted on the driver to at
most ``sample_rows`` labelled URLs, those of the smallest hash; the suffix statistics cover all
labelled URLs. A URL that the trees are fitted to takes its rates from the four of five folds that it
is not in, so that its own label does not leak into them. The fitted trees become one SQL expression, so every URL is scored without Python.

A null URL, or one without ``://``, has an empty host and path, fits no rule and is scored like any
other. With no labelled URLs, or labels of one kind, the score is the labels' rate (0 if none).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.llm.workspace import joined_small, staged

FEATURES = ("url_chars", "host_chars", "labels", "depth", "digits", "entropy", "params", "hyphens", "rate_1", "rate_2")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``text`` is a host and the start of a path, as in ``net/de/``; it fits the host's subdomains, too."""

    verdict: str
    text: str


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path, both empty if there is none."""
    pattern = r"://([^/?#]*)([^?#]*)"
    url = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(url, pattern, 1), _UPPER, _LOWER), F.regexp_extract(url, pattern, 2)


def fitting(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Rules are a list of the caller's."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        name, slash, start = r.text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + start)
        rule, verdict = F.when(fits, r.text).otherwise(rule), F.when(fits, r.verdict).otherwise(verdict)
    return rule, verdict


def _lexical(df: DataFrame, url_col: str) -> DataFrame:
    url, n = F.coalesce(F.col(url_col), F.lit("")), F.greatest(F.length(F.coalesce(F.col(url_col), F.lit(""))), F.lit(1))
    signs = F.split(url, "")
    total = F.aggregate(
        F.transform(F.array_distinct(signs), lambda c: F.size(F.filter(signs, lambda x: x == c)).cast("double")),
        F.lit(0.0), lambda a, k: a + k * F.log2(k),
    )
    labels = F.split("host", r"\.")
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return df.withColumns({
        "url_chars": n.cast("double"),
        "host_chars": F.length("host").cast("double"),
        "labels": F.size(labels).cast("double"),
        "depth": F.length(F.regexp_replace("path", "[^/]", "")).cast("double"),
        "digits": F.length(F.regexp_replace(url, "[^0-9]", "")) / n,
        "entropy": F.round(F.log2(n.cast("double")) - total / n, 9),
        "params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "hyphens": F.length(F.regexp_replace(url, "[^-]", "")).cast("double"),
        "suffix_1": F.substring_index("host", ".", -1),
        "suffix_2": F.substring_index("host", ".", -2),
    })


FOLDS = 5


def _with_rates(df: DataFrame, labelled: DataFrame, out_of_fold: bool = False, strength: float = 10.0) -> DataFrame:
    """Add rate_1 and rate_2: the shrunken block rates of the last one and two host labels.

    With ``out_of_fold`` the rows of ``df`` have a fold, and what ``labelled`` holds of it is left out.
    """
    mean = labelled.agg(F.coalesce(F.avg("blocked"), F.lit(0.0)).alias("m")).first()["m"]
    for k in ("1", "2"):
        suffix = f"suffix_{k}"
        sums = labelled.groupBy(suffix, "fold").agg(F.sum("blocked").alias("_b"), F.count("*").alias("_n"))
        whole = sums.groupBy(suffix).agg(F.sum("_b").alias("_b"), F.sum("_n").alias("_n"))
        if out_of_fold:
            own = sums.select(suffix, "fold", F.col("_b").alias("_own_b"), F.col("_n").alias("_own_n"))
            whole = whole.join(own, suffix).select(suffix, "fold", (F.col("_b") - F.col("_own_b")).alias("_b"), (F.col("_n") - F.col("_own_n")).alias("_n"))
        rate = (F.col("_b") + F.lit(strength * mean)) / (F.col("_n") + F.lit(strength))
        on = [suffix, "fold"] if out_of_fold else [suffix]
        rates = staged(whole.select(*on, rate.alias(f"rate_{k}")), "rates")
        df = joined_small(df, rates, on, "left").withColumn(f"rate_{k}", F.coalesce(f"rate_{k}", F.lit(mean)))
    return df


class Trees:
    """Gradient-boosted regression trees for the log-odds of a 0/1 label, on quantile bins."""

    def __init__(self, trees: int = 30, depth: int = 3, rate: float = 0.3, bins: int = 32, ridge: float = 1.0) -> None:
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.start, self.roots = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        mean = float(y.mean()) if len(y) else 0.0
        mean = min(max(mean, 1e-6), 1 - 1e-6)
        self.start = float(np.log(mean / (1 - mean)))
        if len(y) == 0 or y.min() == y.max():
            return self
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], 1)
        score = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            root = self._grow(binned, edges, y - p, p * (1 - p), np.arange(len(y)), self.depth, score)
            self.roots.append(root)
        return self

    def _grow(self, binned, edges, gradient, weight, rows, depth, score):
        g, h = gradient[rows].sum(), weight[rows].sum()
        best = (1e-6, None, None)
        for f in range(binned.shape[1] if depth else 0):
            size = len(edges[f]) + 1
            left_g = np.cumsum(np.bincount(binned[rows, f], gradient[rows], size))[:-1]
            left_h = np.cumsum(np.bincount(binned[rows, f], weight[rows], size))[:-1]
            if not len(left_g):
                continue
            gain = left_g**2 / (left_h + self.ridge) + (g - left_g) ** 2 / (h - left_h + self.ridge) - g**2 / (h + self.ridge)
            gain[(left_h < 1e-9) | (h - left_h < 1e-9)] = 0
            at = int(gain.argmax())
            if gain[at] > best[0]:
                best = (float(gain[at]), f, at)
        if best[1] is None:
            value = float(self.rate * g / (h + self.ridge))
            score[rows] += value
            return value
        _, f, at = best
        low = binned[rows, f] <= at
        args = (binned, edges, gradient, weight)
        return (f, float(edges[f][at]), self._grow(*args, rows[low], depth - 1, score), self._grow(*args, rows[~low], depth - 1, score))

    def score(self, features: tuple[str, ...]) -> Column:
        """The log-odds as an expression over feature columns."""

        def column(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            f, edge, low, high = node
            return F.when(F.col(features[f]) <= edge, column(low)).otherwise(column(high))

        total = F.lit(self.start)
        for root in self.roots:
            total = total + column(root)
        return total


def filtered(urls: DataFrame, rules: list[Rule], labels: DataFrame | None = None, url_col: str = "url", sample_rows: int = 20_000, most: float = 0.5) -> DataFrame:
    """``urls`` with host, path, rule, verdict and score (the trees' block probability).

    ``labels`` has ``url`` and ``blocked`` (0 or 1); without it the URLs that a rule fits are the
    labelled ones. Columns of those five names in ``urls`` are replaced; others may have any name.
    """
    own = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "score")]
    host, path = host_path(F.col("url"))
    rows = urls.select(F.struct(*own).alias("doc"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rule, verdict = fitting(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict})
    if labels is None:
        known = rows.where("rule IS NOT NULL").select("url", (F.col("verdict") == "block").cast("int").alias("blocked"))
    else:
        known = labels.select("url", "blocked")
    known = known.withColumns(dict(zip(("host", "path"), host_path(F.col("url")))))
    known = _lexical(known, "url").withColumn("fold", F.pmod(F.xxhash64("url", F.lit("fold")), F.lit(FOLDS)))
    known = staged(known, "labelled")
    train = _with_rates(known, known, out_of_fold=True).orderBy(F.xxhash64("url"), "url", "blocked").limit(sample_rows)
    train = train.select(*FEATURES, "blocked").toPandas()  # at most sample_rows rows
    trees = Trees().fit(train[list(FEATURES)].to_numpy(float), train["blocked"].to_numpy(float))
    wide = _with_rates(_lexical(rows, "url"), known)
    score = F.round(1 / (1 + F.exp(-trees.score(FEATURES))), 6)
    wide = wide.withColumn("score", score)
    wide = wide.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") > most, "block").otherwise("allow")))
    return wide.select(*(F.col("doc")[c].alias(c) for c in own), "host", "path", "rule", "verdict", "score")
