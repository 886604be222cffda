"""Embedding whitening from a bit-sliced scatter matrix.

Every entry becomes an integer.  The integers of a dimension, shifted by its
least value, are cut into bit planes; a plane packs one bit of 64 rows into a
word.  The sum over rows of a product of two dimensions is then the sum over
pairs of planes of 2^(a+b) times the set bits of their AND, which is exact.
The sums are centred as integers, ``n * sum(x y) - sum(x) * sum(y)``, and only
then become doubles for the eigenvectors.

Tasks hold one batch of rows and a matrix of planes x planes counts; Spark
adds up their exact sums (decimals), and the driver sees dimensions^2 numbers.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm.common import keep, small_batches, table

STEPS = 64            # integers per unit
OFFSET = 1_000_000    # added to every integer
LARGEST = 1 << 52     # entries beyond +-LARGEST steps count as that many
COMPONENTS = 16
BATCH_ROWS = 8192


def integers(vector: Column) -> Column:
    """``floor(64 c) + 1000000`` of each entry, as longs."""
    limit = float(LARGEST)
    return F.transform(vector, lambda c: F.greatest(F.least(F.floor(c.cast("double") * STEPS).cast("double"), F.lit(limit)), F.lit(-limit)).cast("long") + OFFSET)


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, x)`` of the rows with a vector of finite entries.  Vectors of
    another length than the most frequent one (of several, the longest) are of
    another space and left out, and so are empty ones."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf")))
    rows = df.where(v.isNotNull() & ~bad & (F.size(v) > 0)).select(F.col(id_col).alias("vec_id"), integers(v).alias("x"))
    rows = keep(rows, "vectors")
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == sizes["d"]) if sizes else rows


def _matrix(column: pa.Array) -> np.ndarray:
    """The rows of a list column of equal lengths as a matrix."""
    chunk = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = chunk.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(chunk), -1)


def _ranges(fit_list: DataFrame, dims: int) -> tuple[int, list[int], list[int], list[int]]:
    """Rows, and per dimension sum, least and greatest value."""
    def scan(batches):
        n, total, low, high = 0, np.zeros(dims, object), None, None
        for batch in batches:
            x = _matrix(batch.column(0))
            if len(x):
                n += len(x)
                # |x| < 2^53 and at most BATCH_ROWS rows: high and low halves stay exact
                total += ((x >> 26).sum(axis=0).astype(object) << 26) + (x & ((1 << 26) - 1)).sum(axis=0).astype(object)
                low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
                high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0)),
                 pa.array(low, pa.int64()), pa.array(high, pa.int64())], ["d", "n", "s", "low", "high"])

    parts = fit_list.select("x").mapInArrow(scan, "d int, n long, s decimal(38,0), low long, high long")
    got = parts.groupBy("d").agg(F.sum("n"), F.sum("s"), F.min("low"), F.max("high")).orderBy("d").collect()
    return got[0][1], [int(r[2]) for r in got], [r[3] for r in got], [r[4] for r in got]


def bit_planes(u: np.ndarray, bits: list[int]) -> np.ndarray:
    """Planes of non-negative integers (rows x dimensions), dimension by
    dimension from the lowest bit, 64 rows to a word."""
    words = -(-len(u) // 64)
    planes = np.zeros((sum(bits), words * 8), np.uint8)
    p = 0
    for d, b in enumerate(bits):
        column = np.ascontiguousarray(u[:, d])
        for k in range(b):
            packed = np.packbits(((column >> k) & 1).astype(np.uint8))
            planes[p, : len(packed)] = packed
            p += 1
    return planes.view(np.uint64)


def add_overlaps(planes: np.ndarray, counts: np.ndarray) -> None:
    """Add the set bits of the AND of each pair of planes (the upper half)."""
    for p in range(len(planes)):
        counts[p, p:] += np.bitwise_count(planes[p] & planes[p:]).sum(axis=1, dtype=np.int64)


def weigh(counts: np.ndarray, bits: list[int]) -> np.ndarray:
    """Sums of products (dimensions x dimensions, Python integers) from the
    counts of pairs of planes."""
    dims = len(bits)
    owner = np.repeat(np.arange(dims), bits)
    weight = np.concatenate([np.arange(b) for b in bits]) if sum(bits) else np.zeros(0, np.int64)
    full = np.triu(counts) + np.triu(counts, 1).T
    by_shift = np.zeros((dims, dims), object)
    for s in range(2 * max(bits, default=0)):
        part = np.where(weight[:, None] + weight[None, :] == s, full, 0)
        if part.any():
            rows = np.zeros((dims, part.shape[1]), np.int64)
            np.add.at(rows, owner, part)
            both = np.zeros((dims, dims), np.int64)
            np.add.at(both.T, owner, rows.T)
            by_shift = by_shift + (both.astype(object) << s)
    return by_shift


def _scatter(fit_list: DataFrame, low: list[int], high: list[int]) -> np.ndarray:
    """Exact sums of products of the shifted integers over the fit list."""
    bits = [int(h - l).bit_length() for l, h in zip(low, high)]
    shift = np.array(low, np.int64)
    dims = len(low)

    def scan(batches):
        counts = np.zeros((sum(bits), sum(bits)), np.int64)
        for batch in batches:
            add_overlaps(bit_planes(_matrix(batch.column(0)) - shift, bits), counts)
        if counts.any():
            sums = weigh(counts, bits)
            i, j = np.triu_indices(dims)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()),
                                              pa.array([Decimal(int(v) >> 60) for v in sums[i, j]], pa.decimal128(38, 0)),
                                              pa.array([Decimal(int(v) & (1 << 60) - 1) for v in sums[i, j]], pa.decimal128(38, 0))], ["i", "j", "high", "low"])

    parts = fit_list.select("x").mapInArrow(scan, "i int, j int, high decimal(38,0), low decimal(38,0)")
    found = np.zeros((dims, dims), object)
    for r in parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")).collect():
        found[r["i"], r["j"]] = found[r["j"], r["i"]] = (int(r["high"]) << 60) + int(r["low"])
    return found


@dataclass
class Whitening:
    """Sums over the fit list and its leading components."""

    n: int
    sums: list[int]            # S, of the unshifted integers
    components: np.ndarray     # components x dimensions, unit rows
    eigenvalues: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """Whitened values (rows x components) and exact deviations."""
        s = self.sums
        reach = max((max(abs(self.n * int(a) - t), abs(self.n * int(b) - t)) for a, b, t in zip(x.min(axis=0), x.max(axis=0), s)), default=0)
        if reach * reach * len(s) < 1 << 62:
            gap = self.n * x - np.array(s, np.int64)
            deviation = (gap * gap).sum(axis=1).tolist()
        else:
            gap = self.n * x.astype(object) - np.array(s, object)
            deviation = [int(v) for v in (gap * gap).sum(axis=1)]
        z = (gap.astype(np.float64) / self.n) @ self.components.T / np.sqrt(self.eigenvalues)
        return z, deviation


def fit(fit_list: DataFrame, n_components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors ``fit_list(x)``, which must be
    stored; None without rows.  Directions without variance (eigenvalue zero
    but for rounding) are no components."""
    first = fit_list.select(F.size("x")).first()
    if first is None:
        return None
    n, sums, low, high = _ranges(fit_list, first[0])
    scatter = _scatter(fit_list, low, high)
    shifted = np.array([s - n * l for s, l in zip(sums, low)], object)
    centred = n * scatter - np.outer(shifted, shifted)            # integers: n^2 times the covariance
    cov = np.array([[c / (n * n) for c in row] for row in centred.tolist()], np.float64)
    trace = sum(centred.diagonal().tolist()) / (n * n)
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[: n_components]
    order = [o for o in order if values[o] > max(values.max(), 0) * len(cov) * 1e-13]
    return Whitening(n, sums, vectors[:, order].T.copy(), values[order], values[order] / trace if order else np.zeros(0))


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus
    the identity, measured on the projected rows."""
    k = len(model.components)

    def scan(batches):
        total, second, seen = np.zeros(k), np.zeros((k, k)), False
        for batch in batches:
            if batch.num_rows:
                z = model.project(_matrix(batch.column(0)))[0]
                total, second, seen = total + z.sum(axis=0), second + z.T @ z, True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(range(k + 1), pa.int32()), pa.array([*second.tolist(), total.tolist()], pa.list_(pa.float64()))], ["i", "v"])

    sums = np.zeros((k + 1, k))
    parts = fit_list.select("x").mapInArrow(scan, "i int, v array<double>").select("i", F.posexplode("v").alias("j", "v"))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        sums[r["i"], r["j"]] = r["v"]
    mean = sums[k] / model.n
    return float(np.abs(sums[:k] / model.n - np.outer(mean, mean) - np.eye(k)).max()) if k else 0.0


def whiten(df: DataFrame, n_components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, n, deviation, whitened, explained, identity_error)`` of every
    row of ``df`` with a usable vector (see ``usable``).

    ``whitened`` and ``explained`` are arrays over the components by falling
    eigenvalue, ``deviation`` is an exact decimal(38,0), null beyond 38 digits.  A null id stays null,
    repeated rows each come back but count once in the fit; a null vector or
    one with a null, NaN or infinite entry gives no row.  Vectors that are all
    equal have no component (empty arrays).  An empty table gives an empty
    result.  Other columns are not read.
    """
    spark = df.sparkSession
    small_batches(spark, BATCH_ROWS)
    rows = usable(df, id_col, vector_col)
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
    fit_list = keep(rows.select("x").distinct(), "fit-list")
    model = fit(fit_list, n_components)
    if model is None:
        return spark.createDataFrame([], schema)
    error = identity_error(fit_list, model)
    explained = model.explained.tolist()

    def score(batches):
        for batch in batches:
            m = batch.num_rows
            if m:
                z, deviation = model.project(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([model.n] * m, pa.int64()), pa.array([Decimal(d) if d < 10**38 else None for d in deviation], pa.decimal128(38, 0)),
                     pa.array(z.tolist(), pa.list_(pa.float64())), pa.array([explained] * m, pa.list_(pa.float64())),
                     pa.array([error] * m, pa.float64())], ["vec_id", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(score, schema)


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op12: one row per vector and component.  A deviation beyond a long is
    null."""
    got = whiten(table(spark, sf_dir, "embeddings"))
    each = F.arrays_zip("whitened", "explained")
    return (got.select("vec_id", "n", "deviation", "identity_error", F.posexplode(each).alias("k", "of"))
            .select("vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", F.expr("try_cast(deviation AS long)").alias("deviation"),
                    F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error"))
