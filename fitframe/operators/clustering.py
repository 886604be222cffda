"""Engagement clustering (K1, K2) with Spark ML ``KMeans``.

Features are matched by name suffix, filled with the *fit* medians (exact
distributed quantiles) and standardised with the fit mean and population std,
so scoring a batch replays the training state (W17).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.quantiles import exact_quantiles
from ..functions.sizing import stored_for_fits
from ..state import register


def resolve_features(columns: list[str], suffixes: list[str]) -> list[str]:
    out = []
    for s in suffixes:
        out += [c for c in columns if c.endswith(s) and c not in out]
    return out


@register
@dataclass
class ClusterModel:
    features: list
    medians: dict
    means: dict
    stds: dict
    model: KMeansModel
    label: str = "engagement_cluster"
    cost: float | None = None       # within-cluster sum of squares of the training data

    def _prepared(self, df: DataFrame) -> DataFrame:
        va = VectorAssembler(inputCols=[f"_k_{c}" for c in self.features], outputCol="_kvec")
        return va.transform(df.select("*", *[e.alias(f"_k_{c}") for c, e in self.scaled().items()]))

    def scaled(self) -> dict:
        """The filled, standardised features as columns."""
        return {c: (F.coalesce(exprs.number(c), F.lit(self.medians[c])) - F.lit(self.means[c])) / F.lit(self.stds[c])
                for c in self.features}

    def save(self, path: str, spark=None) -> None:
        """The ML model and the fill and scale values."""
        from ..state import write_values
        write_values(SparkSession.getActiveSession(), f"{path}/_state", "ClusterModel", {
            "features": self.features, "medians": self.medians, "means": self.means, "stds": self.stds, "label": self.label,
            "cost": self.cost})
        self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load_from(cls, spark: SparkSession, path: str, values: dict) -> ClusterModel:
        return cls(model=KMeansModel.load(f"{path}/model"), **values)

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``engagement_cluster`` (int)."""
        out = self.model.transform(self._prepared(df))
        return out.select(*df.columns, F.col("_kcluster").cast("int").alias(self.label))

    def inertia(self) -> float:
        """K2: within-cluster sum of squares of the training data."""
        return self.cost

    def centers(self, spark) -> DataFrame:
        rows = [(i, *map(float, c)) for i, c in enumerate(self.model.clusterCenters())]
        return spark.createDataFrame(rows, ["cluster", *self.features])


def fit_clusters(df: DataFrame, suffixes: list[str] | None = None, k: int = config.CLUSTER_K,
                 seed: int = config.SEED, max_iter: int = config.CLUSTER_MAX_ITER) -> ClusterModel:
    """K1: ``max_iter`` is the fixed value of the original library's default."""
    feats = resolve_features(df.columns, list(config.CLUSTER_FEATURES if suffixes is None else suffixes))
    if not feats:
        raise ValueError("no clustering features found")
    med = exact_quantiles(df, feats, [0.5])
    medians = {c: (med[c][0] if med[c][0] is not None else 0.0) for c in feats}
    filled = [F.coalesce(exprs.number(c), F.lit(medians[c])) for c in feats]
    row = df.agg(*[F.avg(x).alias(f"a{i}") for i, x in enumerate(filled)],
                 *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(filled)]).collect()[0]
    means = {c: row[f"a{i}"] or 0.0 for i, c in enumerate(feats)}
    stds = {c: (row[f"s{i}"] if row[f"s{i}"] else 1.0) for i, c in enumerate(feats)}
    tmp = ClusterModel(feats, medians, means, stds, None)
    # KMeans passes over its input many times: store it once
    prepared, _ = stored_for_fits(tmp._prepared(df).select("_kvec"))
    km = KMeans(k=k, seed=seed, featuresCol="_kvec", predictionCol="_kcluster", maxIter=max_iter)
    tmp.model = km.fit(prepared)
    tmp.cost = float(tmp.model.summary.trainingCost)
    return tmp
