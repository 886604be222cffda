"""One saved artefact that scores raw rows.

``ChainTransformer`` is an ML stage around fitted states; together with the
assembler and the model it makes one ``PipelineModel``.  It saves the states
beside its metadata, so ``PipelineModel.load`` in a new process, without the
code that fitted the chain, gives the same scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.base import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame

from ..state import Fitted, load, register
from . import scoring


@register
@dataclass
class AlignState(Fitted):
    """Z2 as a state: the model's features in order and the columns to keep."""

    features: list
    keep: list

    def transform(self, df: DataFrame) -> DataFrame:
        return scoring.align_features(df, self.features, keep=[c for c in self.keep if c not in set(self.features)])


class ChainTransformer(Transformer, MLWritable, MLReadable):
    """Replays named fitted states, in order."""

    def __init__(self, states: Sequence[tuple[str, Fitted]] = ()):
        super().__init__()
        self.states = list(states)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        for _, state in self.states:
            dataset = state.transform(dataset)
        return dataset

    def write(self) -> MLWriter:
        return _ChainWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ChainReader(cls)


class _ChainWriter(MLWriter):
    def __init__(self, instance: ChainTransformer):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, extraMetadata={"steps": [n for n, _ in self.instance.states]})
        for i, (_, state) in enumerate(self.instance.states):
            state.save(f"{path}/states/{i}", self.sparkSession)


class _ChainReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ChainTransformer:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls([(n, load(self.sparkSession, f"{path}/states/{i}")) for i, n in enumerate(metadata["steps"])])
        out._resetUid(metadata["uid"])
        return out


class StackStage(Model, MLWritable, MLReadable):
    """A stacked ensemble (M3) as an ML stage."""

    def __init__(self, stack=None):
        super().__init__()
        self.stack = stack

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return self.stack.transform(dataset)

    def write(self) -> MLWriter:
        return _StackWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StackReader(cls)


class _StackWriter(_ChainWriter):
    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.stack.save(f"{path}/stack")


class _StackReader(_ChainReader):
    def load(self, path: str) -> StackStage:
        from .training import StackModel
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls(StackModel.load(self.sparkSession, f"{path}/stack"))
        out._resetUid(metadata["uid"])
        return out


def scoring_model(states: Sequence[tuple[str, Fitted]], features: Sequence[str], model, keep: Sequence[str] = ()) -> PipelineModel:
    """Chain states, alignment to ``features``, assembler and ``model`` as one
    ``PipelineModel``; rows carry the columns ``keep`` through."""
    missing = [n for n, s in states if s is None]
    if missing:
        raise ValueError(f"steps without a state cannot be saved: {missing}")
    features = list(features)
    stage = model if isinstance(model, Transformer) else StackStage(model)
    return PipelineModel([ChainTransformer([*states, ("align", AlignState(features, list(keep)))]),
                          VectorAssembler(inputCols=features, outputCol="features"), stage])


def score(raw: DataFrame, scorer: PipelineModel, keep: Sequence[str], threshold: float = 0.5) -> DataFrame:
    """``keep``, the probability, its text and the label of every row."""
    out = scorer.transform(raw).select(*keep, vector_to_array("probability")[1].alias("probability"))
    return scoring.format_scores(out, "probability", threshold)
