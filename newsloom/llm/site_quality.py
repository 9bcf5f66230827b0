"""Quality by hierarchical empirical Bayes: a document's own evidence on its site's posterior.

A logistic model on measures of the text gives each document's evidence. Its probabilities, and the
labels where there are any, are added up by host and by path. A host's share of good documents is
drawn towards the global share, a path's towards its host's, each as strongly as the sites' spread
says (method of moments), so a site with few documents keeps its parent's share.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import settle
from .common import SPACE, drop_rows, looked_up, saved, text_or_empty

SYMBOLS = "#*$%&|<>"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"


NAMES = (
    "symbols", "bars", "exclaims", "upper", "digits", "repeats", "repeated_lines", "words", "word_length", "repeats_by_words",
)


def with_measures(rows: DataFrame, text_col: str = "text", before: str = "m_") -> DataFrame:
    """Measures of a whole text, all zero for an empty one, in place of the text; `rows` has no column `_cut`.

    A text is run through once for its words, once for its lines and once for the characters that are
    counted: what is counted is settled first, so that no measure goes back to the text.
    """
    text = text_or_empty(text_col)
    counted = f"{SYMBOLS}!{_UPPER}{_DIGITS}"
    cut = settle(rows, "_cut", F.struct(
        F.length(text).alias("length"),
        F.regexp_replace(text, f"[^{counted}]+", "").alias("signs"),
        F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda line: F.trim(line) != "").alias("lines"),
    )).drop(text_col)
    part = lambda name: F.col("_cut")[name]
    cut = settle(cut, "_cut", F.struct(
        part("length").alias("length"), part("signs").alias("signs"), F.length(part("signs")).alias("all"),
        *[F.size(part(name)).alias(name) for name in ("words", "lines")],
        *[F.size(F.array_distinct(part(name))).alias(f"unlike_{name}") for name in ("words", "lines")],
    ))
    length, n = part("length"), part("words")

    def share(characters: str) -> Column:
        return (part("all") - F.length(F.translate(part("signs"), characters, ""))) / F.greatest(length, F.lit(1))

    def repeats(name: str) -> Column:
        return F.when(part(name) == 0, 0.0).otherwise(1 - part(f"unlike_{name}") / part(name))

    found = (
        share(SYMBOLS), share("|"), share("!"), share(_UPPER), share(_DIGITS), repeats("words"), repeats("lines"),
        F.log1p(n.cast("double")), F.when(n == 0, 0.0).otherwise(length / F.greatest(n, F.lit(1))),
        repeats("words") * F.log1p(n.cast("double")),
    )
    values = [F.coalesce(column, F.lit(0.0)).cast("double").alias(f"{before}{name}") for name, column in zip(NAMES, found)]
    return cut.select(*[c for c in cut.columns if c != "_cut"], *values)


@dataclass
class Model:
    mean: list[float]
    scale: list[float]
    weights: list[float]
    bias: float

    def logit(self, names) -> Column:
        total = F.lit(self.bias)
        for name, m, s, w in zip(names, self.mean, self.scale, self.weights):
            total = total + (F.col(name) - F.lit(m)) / F.lit(s) * F.lit(w)
        return total


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 30) -> Model:
    """Logistic regression by Newton's method on scaled measures. Without rows of both labels the
    model knows nothing: its logit is 0 everywhere."""
    width = x.shape[1]
    if len(set(y.tolist())) < 2:
        return Model([0.0] * width, [1.0] * width, [0.0] * width, 0.0)
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.c_[np.clip((x - mean) / scale, -30, 30), np.ones(len(x))]
    w, penalty = np.zeros(width + 1), np.diag([ridge] * width + [1e-3])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T * (p * (1 - p)) @ z + penalty, z.T @ (p - y) + penalty @ w)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return Model(mean.tolist(), scale.tolist(), w[:-1].tolist(), float(w[-1]))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(30.0)), F.lit(-30.0))))


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def strength(sites: DataFrame, prior: Column) -> float:
    """How many documents the prior counts for, from the sites' spread around it: (s, n) are the sums
    and numbers of each site's documents."""
    rate = F.col("s") / F.col("n")
    row = sites.agg(
        F.sum(F.col("n") * (rate - prior) ** 2).alias("spread"),
        F.sum(prior * (1 - prior)).alias("noise"),  # expected share of chance in the spread
        F.sum(F.col("n") * prior * (1 - prior)).alias("most"),
        F.count("*").alias("sites"),
    ).first()
    if not row["sites"] or not row["most"]:
        return 1.0
    excess = (row["spread"] - row["noise"]) / row["most"]  # of the largest possible variance
    return float(min(max(1 / excess - 1, 1.0), 1e6)) if excess > 1e-6 else 1e6


def site_quality(
    docs: DataFrame,
    labels: DataFrame,
    host_col: str = "source",
    path_col: str = "lang",
    fit_rows: int = 20_000,
    min_quality: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id_col: str = "doc_id",
    label_col: str = "quality",
) -> DataFrame:
    """One row per row of `docs`: doc_id, evidence (the text's own probability of being good),
    host_share and path_share (posterior shares of good documents), quality (the combination) and
    kept (`quality` is at least `min_quality`).

    The model is fitted on the `fit_rows` labelled documents whose ids hash lowest, the one bounded
    sample; all else counts every document. A null text is empty. Null hosts, or paths, are a site of
    their own. Null labels count as unlabelled; of repeated labels of an id the lowest counts. Rows
    that repeat an id share its label. Without labels of both kinds nothing is known, and all
    documents are kept. Other columns are not read; an empty table gives no rows.
    """
    return _judged(docs, labels, host_col, path_col, fit_rows, min_quality, id_col, text_col, label_id_col, label_col).drop("key")


def good_documents(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """The rows of `docs` that `site_quality` keeps, with all their columns."""
    how = {
        "host_col": "source", "path_col": "lang", "fit_rows": 20_000, "min_quality": 0.3, "id_col": "doc_id",
        "text_col": "text", "label_id_col": "doc_id", "label_col": "quality",
    } | how
    key = _key(how["host_col"], how["path_col"], how["text_col"])
    return drop_rows(docs, key, _judged(docs, labels, **how), how["id_col"])


def _key(host_col: str, path_col: str, text_col: str) -> Column:
    """What a verdict depends on besides the id: the text and its site."""
    site = F.to_json(F.struct(F.col(host_col).alias("h"), F.col(path_col).alias("p")))
    return F.md5(F.concat(site, F.lit("\n"), text_or_empty(text_col)))


def _judged(docs, labels, host_col, path_col, fit_rows, min_quality, id_col, text_col, label_id_col, label_col) -> DataFrame:
    given = docs.select(
        F.col(id_col).alias("doc_id"), F.col(host_col).alias("host"), F.col(path_col).alias("path"),
        _key(host_col, path_col, text_col).alias("key"), F.col(text_col).alias("text"),
    )
    rows = saved(with_measures(given), "measures")
    names = [f"m_{name}" for name in NAMES]
    marked = saved(
        labels.where(F.col(label_id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(label_id_col).alias("_id")).agg(F.min(F.col(label_col)).cast("double").alias("label")),
        "labels",
    )
    sample = marked.orderBy(F.xxhash64("_id"), "_id").limit(fit_rows)
    one = F.min_by(F.struct(*names, "label"), "key")  # of the rows that repeat an id, always the same
    known = rows.join(F.broadcast(sample), rows["doc_id"] == sample["_id"]).groupBy("_id").agg(one.alias("row"))
    known = known.orderBy("_id").select("row.*")
    table = known.select(*names, "label").toPandas()
    model = fit(table[names].to_numpy(dtype=float), table["label"].to_numpy(dtype=float))

    logit = F.greatest(F.least(model.logit(names), F.lit(15.0)), F.lit(-15.0))
    scored = (
        rows.join(marked.hint("merge"), rows["doc_id"] == marked["_id"], "left")
        .select("doc_id", "host", "path", "key", logit.alias("_logit"), "label")
        .withColumn("_good", F.coalesce("label", _sigmoid(F.col("_logit"))))
    )
    scored = saved(scored, "scored")
    paths = saved(scored.groupBy("host", "path").agg(F.sum("_good").alias("s"), F.count("*").alias("n")), "paths")
    hosts = saved(paths.groupBy("host").agg(F.sum("s").alias("s"), F.sum("n").alias("n")), "hosts")
    total = hosts.agg(F.sum("s").alias("s"), F.sum("n").alias("n")).first()
    overall = (total["s"] + 1) / (total["n"] + 2) if total["n"] else 0.5
    prior = F.lit(float(overall))

    k = strength(hosts, prior)
    hosts = saved(hosts.withColumn("host_share", (k * prior + F.col("s")) / (k + F.col("n"))).select("host", "host_share"), "hosts")
    nested = saved(looked_up(paths, hosts, "host"), "paths")
    k = strength(nested, F.col("host_share"))
    shares = saved(
        nested.select("host", "path", "host_share", ((k * F.col("host_share") + F.col("s")) / (k + F.col("n"))).alias("path_share")),
        "shares",
    )
    placed = looked_up(scored, shares, "host", "path")
    combined = _sigmoid(F.col("_logit") + _logit(F.col("path_share")) - _logit(prior))
    judged = placed.select(
        "doc_id",
        F.round(_sigmoid(F.col("_logit")), 6).alias("evidence"),
        F.round("host_share", 6).alias("host_share"),
        F.round("path_share", 6).alias("path_share"),
        F.round(combined, 6).alias("quality"),
        "key",
    )
    return judged.withColumn("kept", F.col("quality") >= F.lit(min_quality) if any(model.weights) else F.lit(True))
