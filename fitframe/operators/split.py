"""Splits and folds.

The stratified split needs no sort and no per-class task: every row gets a
hash of its key, salted by purpose and seed, and the per-class cuts are found
with the exact distributed quantile search (one column per class, so all
classes resolve together).  The split is then a filter and a fold a ``CASE``,
so train and test are two lazy views of the same scan.  The salts of split,
cross-validation and stacking differ, so folds of a train side are not cut by
the split.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import config
from ..functions import exprs
from ..functions.ordered import running_totals
from ..functions.quantiles import exact_quantiles
from ..functions.sizing import materialize_state


def drop_null_target(df: DataFrame, target: str) -> DataFrame:
    """Rows with a target, target cast to int."""
    return df.where(F.col(target).isNotNull()).withColumn(target, F.col(target).cast("int"))


# Up to so many classes are cut at quantiles, one column of the search each;
# more are ranked, with the same result.
SEARCHED_CLASSES = 200


def hash_key(keys: Iterable[str], salt: str, seed: int = config.SEED):
    """Hash of the key columns in [0, 1): the first 13 hexadecimal digits of
    the MD5 of ``key|key|salt|seed`` over 2**52, which any engine can repeat."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.lit(salt), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def _pieces(df: DataFrame, target: str, u, probs: list[float]) -> DataFrame:
    """``df`` with ``_piece``: how many of the ``probs`` quantiles of ``u``
    within the row's class ``u`` is above; NULL without a class."""
    classes = [r[0] for r in df.select(target).where(F.col(target).isNotNull()).distinct().limit(SEARCHED_CLASSES + 1).collect()]
    if len(classes) > SEARCHED_CLASSES:
        return _ranked_pieces(df, target, u, probs)
    cuts = _class_cuts(df, target, u, probs, classes)
    piece = F.lit(None).cast("int")
    for c, v in cuts.items():
        above = F.lit(0)
        for edge in v:
            above = above + (F.col("_u") > F.lit(edge)).cast("int")
        piece = F.when(F.col(target) == F.lit(c), above).otherwise(piece)
    return df.withColumn("_u", u).withColumn("_piece", piece).drop("_u")


def _ranked_pieces(df: DataFrame, target: str, u, probs: list[float]) -> DataFrame:
    """As ``_pieces``, for any number of classes: rows are ranked within their
    class in ranges, and cut at the ranks below the quantiles."""
    tagged = df.withColumn("_u", u)
    counts = materialize_state(tagged.where(F.col(target).isNotNull()).groupBy(F.col(target).alias("_class"), "_u").agg(F.count(F.lit(1)).alias("_n")))
    ranks = running_totals(counts.df, "_u", ["_n"], by=["_class"], n_rows=counts.rows)
    sizes = counts.df.groupBy("_class").agg(F.sum("_n").alias("_size"))
    piece = F.lit(0)
    for p in probs:
        piece = piece + (F.col("cum__n") - 1 > F.floor(F.lit(p) * (F.col("_size") - 1))).cast("int")
    cut = ranks.join(sizes, "_class").select("_class", F.col("_u").alias("_at"), piece.alias("_piece"))
    return (tagged.join(cut, (F.col(target) == F.col("_class")) & (F.col("_u") == F.col("_at")), "left")
            .drop("_class", "_at", "_u"))


def _class_cuts(df: DataFrame, target: str, u, probs: list[float], classes: list) -> dict:
    """Per class of ``target``: the values of ``u`` at ``probs``."""
    probe = df.select(*[F.when(F.col(target) == F.lit(c), u).alias(f"_h{i}") for i, c in enumerate(classes)])
    q = exact_quantiles(probe, [f"_h{i}" for i in range(len(classes))], probs)
    return {c: q[f"_h{i}"] for i, c in enumerate(classes)}


def stratified_split(df: DataFrame, target: str, keys: Iterable[str], test_size: float = config.TEST_SIZE,
                     seed: int = config.SEED) -> tuple[DataFrame, DataFrame]:
    """Per-class hash cut so each class keeps ``1 - test_size`` of its rows
    in train (up to hash ties)."""
    tagged = _pieces(df, target, hash_key(list(keys), "split", seed), [1 - test_size])
    return tagged.where("_piece = 0").drop("_piece"), tagged.where("_piece = 1").drop("_piece")


def fold_column(df: DataFrame, keys: Iterable[str], k: int, target: str, seed: int = config.SEED,
                name: str = "fold", salt: str = "cv") -> DataFrame:
    """Stratified fold id in ``[0, k)``: within every class of ``target`` the
    folds are cut at the k-quantiles of the salted hash, so their sizes differ
    by one row at most (up to hash ties).  Rows without a class have no fold."""
    return _pieces(df, target, hash_key(list(keys), salt, seed), [i / k for i in range(1, k)]).withColumnRenamed("_piece", name)


def variant_columns(train: DataFrame, test: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """D3: numeric columns with std > 0 on both sides (two aggregations)."""
    cols = [c for c in exprs.numeric_columns(train, exclude) if c in test.columns]
    if not cols:
        return []
    a = train.agg(*[F.stddev_samp(exprs.number(c)).alias(c) for c in cols]).collect()[0]
    b = test.agg(*[F.stddev_samp(exprs.number(c)).alias(c) for c in cols]).collect()[0]
    return [c for c in cols if (a[c] or 0) > 0 and (b[c] or 0) > 0]
