"""Stages written to a folder and read back: parameters as metadata, what a stage holds beside them.

Tables become parquet folders, learned taggers their arrays in one, all else is metadata. Tables are
read where they were written, so the folder has to stay as long as the stage is used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReader, MLWriter
from pyspark.sql import DataFrame, SparkSession

from ..operators.perceptron import ContextTagger
from ..operators.phrases import Gazetteer
from ..operators.tagger import EntityTagger

MODELS = {"context-tagger": ContextTagger, "entity-tagger": EntityTagger}


def _keep(spark: SparkSession, value, path: str) -> dict:
    """Write a value; what has to be known to read it again."""
    if isinstance(value, Gazetteer):
        value = value.table.select("phrase", "entity_type")
    if isinstance(value, DataFrame):
        value.write.parquet(path)
        return {"kind": "table"}
    for kind, model in MODELS.items():
        if isinstance(value, model):
            fields = vars(value)
            arrays = {name: field for name, field in fields.items() if isinstance(field, np.ndarray)}
            spark.createDataFrame(pa.table({
                "name": list(arrays),
                "type": [str(array.dtype) for array in arrays.values()],
                "shape": pa.array([list(array.shape) for array in arrays.values()], pa.list_(pa.int64())),
                "numbers": pa.array([array.ravel().astype(float) for array in arrays.values()], pa.list_(pa.float64())),
            })).write.parquet(path)
            return {"kind": kind, "fields": {name: field for name, field in fields.items() if name not in arrays}}
    return {"kind": "plain", "value": value}


def _restored(spark: SparkSession, held: dict, path: str):
    if held["kind"] == "plain":
        return held["value"]
    table = spark.read.parquet(path)
    if held["kind"] == "table":
        return table
    rows = table.toArrow()
    arrays = {
        name.as_py(): numbers.values.to_numpy().astype(kind.as_py()).reshape(shape.as_py())
        for name, kind, shape, numbers in zip(*(rows.column(c) for c in ("name", "type", "shape", "numbers")))
    }
    return MODELS[held["kind"]](**held["fields"], **arrays)


class StageWriter(MLWriter):
    def __init__(self, stage):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        held = {name: _keep(spark, getattr(self.stage, name), f"{path}/held/{name}") for name in self.stage.holds}
        DefaultParamsWriter.saveMetadata(self.stage, path, spark, extraMetadata={"held": held})


class StageReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        spark = self.sparkSession
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        stage = self.kind.blank()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        for name, held in metadata["held"].items():
            setattr(stage, name, _restored(spark, held, f"{path}/held/{name}"))
        return stage
