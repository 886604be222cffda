"""Fitted-state contract shared by every step.

``fit(df) -> Fitted`` runs a few wide aggregations and keeps a small state;
``Fitted.transform(df)`` is a pure column expression (or a size-checked join)
so a whole chain stays one lazy plan.  A state saves to Parquet as a long
table ``(step, key, value)`` with JSON values; state that is itself a table
(rare labels, target encodings) is saved as its own Parquet folder next to
it.  Loading a missing state raises instead of silently passing data through.
"""

from __future__ import annotations

import dataclasses
import importlib
import json
import os
import pkgutil

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

STATE_SCHEMA = T.StructType([
    T.StructField("step", T.StringType(), False),
    T.StructField("key", T.StringType(), False),
    T.StructField("value", T.StringType(), True),
])

_REGISTRY: dict[str, type] = {}


def register(cls):
    _REGISTRY[cls.__name__] = cls
    return cls


class Fitted:
    """Base for fitted steps (dataclasses).  DataFrame fields are tables."""

    def transform(self, df: DataFrame) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    # -- persistence --------------------------------------------------------
    def _split(self):
        scalars, tables = {}, {}
        for f in dataclasses.fields(self):
            v = getattr(self, f.name)
            if isinstance(v, DataFrame):
                tables[f.name] = v
            elif hasattr(v, "df") and isinstance(getattr(v, "df"), DataFrame):
                tables[f.name] = v.df
            else:
                scalars[f.name] = v
        return scalars, tables

    def state_frame(self, spark: SparkSession) -> DataFrame:
        scalars, _ = self._split()
        # a state of tables only still names its kind
        rows = [(type(self).__name__, k, json.dumps(v)) for k, v in scalars.items()] or [(type(self).__name__, "", "null")]
        return spark.createDataFrame(rows, STATE_SCHEMA)

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        scalars, tables = self._split()
        spark = spark or SparkSession.getActiveSession()
        self.state_frame(spark).coalesce(1).write.mode("overwrite").parquet(os.path.join(path, "_state"))
        for name, t in tables.items():
            t.write.mode("overwrite").parquet(os.path.join(path, name))


def write_values(spark: SparkSession, path: str, kind: str, values: dict) -> None:
    """A state table of JSON values."""
    rows = [(kind, k, json.dumps(v)) for k, v in values.items()] or [(kind, "", "null")]
    spark.createDataFrame(rows, STATE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)


def _kind(name: str) -> type:
    """The registered class of a saved state; a process that only loads has
    not imported the modules of its steps yet."""
    if name not in _REGISTRY:
        from . import operators
        for module in pkgutil.iter_modules(operators.__path__):
            importlib.import_module(f"{operators.__name__}.{module.name}")
        importlib.import_module(f"{__package__}.plans.pipeline")
    return _REGISTRY[name]


def load(spark: SparkSession, path: str) -> Fitted:
    try:
        rows = spark.read.parquet(os.path.join(path, "_state")).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no fitted state at {path}") from e
    if not rows:
        raise FileNotFoundError(f"empty fitted state at {path}")
    cls = _kind(rows[0]["step"])
    if cls.__name__ == "TargetEncodeState":
        from .operators.encoding import load_target_encoder
        return load_target_encoder(spark, path)
    kwargs = {r["key"]: json.loads(r["value"]) for r in rows if r["key"]}
    if hasattr(cls, "load_from"):
        return cls.load_from(spark, path, kwargs)
    for f in dataclasses.fields(cls):
        if f.name not in kwargs:
            kwargs[f.name] = spark.read.parquet(os.path.join(path, f.name))
    return _restore(cls, kwargs)


def _restore(cls, kwargs):
    hook = getattr(cls, "_from_state", None)
    return hook(kwargs) if hook else cls(**kwargs)
