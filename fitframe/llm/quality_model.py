"""Quality classifier: a regularised quadratic discriminant.

Every text becomes a row of transformed statistics (lengths, shares, repeats).
Each class has a mean and a covariance, shrunk towards the covariance of both
classes together and towards a multiple of the identity.  The score is the
logistic of the difference of the two log densities, priors included; each
Mahalanobis distance is a sum of squares through the inverse Cholesky factor,
computed once on the driver from a matrix of FEATURES x FEATURES.

The moments are sums over all labelled rows given to ``fit``; the driver sees
one row per class and pair of features.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm.common import keep, table, words

POOLED_SHRINK = 0.15   # weight of the covariance of both classes together
RIDGE = 0.02           # weight of the identity, on standardised features

_LETTER = r"\p{L}"


# Typical share of each statistic: every text is scored as if it had so much
# more of ordinary text (BLANK words, lines or 6 x BLANK characters), which
# keeps the shares of short texts from being extreme.
BLANK = 20
TYPICAL = {"f_distinct": 0.8, "f_twice": 0.0, "f_short": 0.4, "f_upper": 0.03, "f_digits": 0.0, "f_symbols": 0.0,
           "f_marks": 0.0, "f_stops": 0.12, "f_letters": 0.8, "f_lines": 0.03, "f_dup_lines": 0.0}


def _share(name: str, part: Column, whole: Column, blank: int = BLANK) -> Column:
    """log of a share, with a floor that keeps zero finite."""
    return F.log((part + F.lit(TYPICAL[name] * blank)) / (whole + F.lit(blank)) + F.lit(0.002))


def statistics(text: Column) -> dict[str, Column]:
    """Transformed statistics of a whole text; null counts as empty, and an
    empty text has finite values."""
    t = F.coalesce(text, F.lit(""))
    w = words(t)
    letters = F.regexp_count(t, F.lit(_LETTER))
    lines = F.filter(F.split(t, "\n"), lambda x: F.trim(x) != "")
    per_words = F.transform(F.array(w), lambda a: F.struct(
        F.size(a).alias("n"),
        F.size(F.array_distinct(a)).alias("distinct"),
        F.aggregate(a, F.lit(0), lambda s, x: s + F.length(x)).alias("chars"),
        F.size(F.filter(a, lambda x, i: (i > 0) & (x == F.get(a, i - 1)))).alias("twice"),
        F.size(F.filter(a, lambda x: F.length(x) <= 3)).alias("short"),
    ))[0]
    per_lines = F.transform(F.array(lines), lambda a: F.struct(
        F.size(a).alias("n"), F.size(F.array_distinct(a)).alias("distinct")))[0]
    return {"w": per_words, "l": per_lines, "chars": F.length(t), "letters": letters,
            "upper": F.regexp_count(t, F.lit(r"\p{Lu}")), "digits": F.regexp_count(t, F.lit(r"\p{Nd}")),
            "symbols": F.length(t) - F.length(F.translate(t, "#*$%&|<>", "")),
            "marks": F.length(t) - F.length(F.translate(t, "!?", "")),
            "stops": F.length(t) - F.length(F.translate(t, ".,;:", ""))}


def features(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` must not hold columns named like the statistics; callers
    select (id, text) first."""
    s = docs.select("*", *[c.alias(f"s_{k}") for k, c in statistics(F.col(text_col)).items()]).drop(text_col)
    n, ln = F.col("s_w.n"), F.col("s_l.n")
    chars = BLANK * 6
    shares = {
        "f_distinct": (F.col("s_w.distinct"), n), "f_twice": (F.col("s_w.twice"), n), "f_short": (F.col("s_w.short"), n),
        "f_upper": (F.col("s_upper"), F.col("s_letters"), chars), "f_digits": (F.col("s_digits"), F.col("s_chars"), chars),
        "f_symbols": (F.col("s_symbols"), n), "f_marks": (F.col("s_marks"), n), "f_stops": (F.col("s_stops"), n),
        "f_letters": (F.col("s_letters"), F.col("s_chars"), chars), "f_lines": (ln, n),
        "f_dup_lines": (ln - F.col("s_l.distinct"), ln),
    }
    made = {"f_words": F.log(n + BLANK), "f_word_len": F.log((F.col("s_w.chars") + 5.3 * BLANK) / (n + BLANK)),
            **{k: _share(k, *v) for k, v in shares.items()}}
    return s.select(*docs.drop(text_col).columns, *[c.cast("double").alias(k) for k, c in made.items()])


FEATURES = ("f_words", "f_word_len", "f_distinct", "f_twice", "f_short", "f_upper", "f_digits", "f_symbols",
            "f_marks", "f_stops", "f_letters", "f_lines", "f_dup_lines")


@dataclass
class Discriminant:
    """Two Gaussian classes on standardised features."""

    centre: np.ndarray
    scale: np.ndarray
    means: dict[int, np.ndarray]
    inverse_factors: dict[int, np.ndarray]  # inverse of the Cholesky factor
    offsets: dict[int, float]               # log prior - half log determinant

    def score(self) -> Column:
        """Probability of class 1 as a column over FEATURES."""
        if len(self.means) < 2:  # no labels: undecided; one class: that class
            return F.lit({(): 0.5, (0,): 0.0, (1,): 1.0}[tuple(self.means)])
        z = [(F.col(f) - float(c)) / float(s) for f, c, s in zip(FEATURES, self.centre, self.scale)]
        density = {}
        for label, factor in self.inverse_factors.items():
            total = F.lit(float(self.offsets[label]))
            for i in range(len(FEATURES)):
                shift = float(-(factor[i, : i + 1] @ self.means[label][: i + 1]))
                row = F.lit(shift)
                for j in range(i + 1):
                    row = row + z[j] * float(factor[i, j])
                total = total - F.lit(0.5) * row * row
            density[label] = total
        gap = F.least(F.greatest(density[1] - density[0], F.lit(-700.0)), F.lit(700.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-gap))


def fit(rows: DataFrame, label: str = "label") -> Discriminant:
    """Fit on feature rows with a 0/1 ``label``; other labels are left out.
    One aggregation; a class without rows is absent from the result."""
    k = len(FEATURES)
    sums = [F.count("*").alias("n")] + [F.sum(f).alias(f"m{i}") for i, f in enumerate(FEATURES)]
    sums += [F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"c{i}_{j}") for i in range(k) for j in range(i + 1)]
    got = {r[label]: r for r in rows.where(F.col(label).isin(0, 1)).groupBy(label).agg(*sums).collect()}
    total = sum(r["n"] for r in got.values())
    if not total:
        return Discriminant(np.zeros(k), np.ones(k), {}, {}, {})

    def moments(r):
        m = np.array([r[f"m{i}"] for i in range(k)]) / r["n"]
        c = np.zeros((k, k))
        for i in range(k):
            for j in range(i + 1):
                c[i, j] = c[j, i] = r[f"c{i}_{j}"] / r["n"]
        return m, c

    raw = {y: moments(r) for y, r in sorted(got.items())}
    weight = {y: got[y]["n"] / total for y in raw}
    centre = sum(weight[y] * raw[y][0] for y in raw)
    second = sum(weight[y] * raw[y][1] for y in raw)
    scale = np.sqrt(np.maximum(np.diag(second) - centre ** 2, 0.0))
    scale[scale < 1e-6] = 1.0
    means = {y: (m - centre) / scale for y, (m, _) in raw.items()}
    within = {y: (c - np.outer(m, m)) / np.outer(scale, scale) for y, (m, c) in raw.items()}
    pooled = sum(weight[y] * within[y] for y in raw)
    factors, offsets = {}, {}
    for y, cov in within.items():
        cov = (1 - POOLED_SHRINK) * cov + POOLED_SHRINK * pooled
        cov = (1 - RIDGE) * cov + RIDGE * np.eye(k)
        low = np.linalg.cholesky((cov + cov.T) / 2)
        factors[y] = np.linalg.solve(low, np.eye(k))
        offsets[y] = math.log(weight[y]) - float(np.log(np.diag(low)).sum())
    return Discriminant(centre, scale, means, factors, offsets)


def score_documents(docs: DataFrame, labels: DataFrame, train: Column | None = None, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """``(id, score, predicted, text_key)`` of every row of ``docs``, fitted
    on the labelled rows whose id satisfies ``train`` (a condition on a
    column ``id``; all of them by default).

    Null and empty texts are scored like any other.  Repeated rows are each
    scored; an id labelled several times counts once per label value, and null
    ids and labels teach nothing.  Without any label each score is 0.5.  Other
    columns of ``docs`` are not read.
    """
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                      F.xxhash64(F.col(text_col)).alias("text_key"))
    rows = keep(features(src, "text"), "quality")
    taught = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).dropna().distinct()
    if train is not None:
        taught = taught.where(train)
    model = fit(rows.join(taught, "id"))
    return (rows.select("id", "text_key", model.score().alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7: learn on the rows that are not held out, score all documents."""
    scored = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                             train=~held_out(F.col("id")))
    return scored.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", "predicted")
