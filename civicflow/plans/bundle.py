"""A saved model with its manifest (IO9): what it was trained on, checked at load.

``path/pipeline`` is the Spark ML pipeline; ``path/manifest`` is one JSON line.
The manifest is written last, so a folder without one is an unfinished save.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field

import pyspark
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

FORMAT = 1


class ModelMismatch(ValueError):
    """The saved model was trained for other features, another label or another input schema."""


@dataclass
class Manifest:
    """Feature list in vector order, labels of each encoded feature in code order, split, sizes."""
    model_type: str
    features: list[str]
    label: str
    label_maps: dict[str, list[str]] = field(default_factory=dict)
    split: dict = field(default_factory=dict)
    sizes: dict = field(default_factory=dict)
    train_size: int = 0
    test_size: int = 0
    importance: list = field(default_factory=list)
    inputs: str = ""
    stages: list[str] = field(default_factory=list)
    spark_version: str = pyspark.__version__
    format: int = FORMAT


def inputs_digest(schema: T.StructType) -> str:
    """SHA-256 of the column names and types, by name."""
    text = ",".join(sorted(f"{f.name}:{f.dataType.simpleString()}" for f in schema.fields))
    return hashlib.sha256(text.encode()).hexdigest()


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(jpath)


def save(model: PipelineModel, manifest: Manifest, path: str) -> str:
    """Writes the pipeline, then its manifest.  A model already at ``path`` is replaced."""
    spark = SparkSession.getActiveSession()
    base = path.rstrip("/")
    manifest.stages = [type(s).__name__ for s in model.stages]
    model.write().overwrite().save(f"{base}/pipeline")
    line = json.dumps(asdict(manifest), ensure_ascii=False)
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{base}/manifest")
    return path


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The manifest of a saved model; a missing model raises ``FileNotFoundError``."""
    base = path.rstrip("/")
    if not _exists(spark, f"{base}/manifest/_SUCCESS"):
        raise FileNotFoundError(f"no saved model at {path}")
    found = json.loads(spark.read.text(f"{base}/manifest").first()[0])
    if found.get("format") != FORMAT:
        raise ModelMismatch(f"{path}: manifest format {found.get('format')}, expected {FORMAT}")
    return Manifest(**found)


def load(spark: SparkSession, path: str, features: list[str], label: str, inputs: str) -> tuple[PipelineModel, Manifest]:
    """The pipeline and its manifest, if it was trained for these features, label and input columns."""
    manifest = read_manifest(spark, path)
    wrong = [f"{name}: saved {have!r}, expected {want!r}" for name, have, want in (
        ("features", manifest.features, features), ("label", manifest.label, label), ("inputs", manifest.inputs, inputs))
        if have != want]
    if wrong:
        raise ModelMismatch(f"{path}: " + "; ".join(wrong))
    model = PipelineModel.load(f"{path.rstrip('/')}/pipeline")
    stages = [type(s).__name__ for s in model.stages]
    if stages != manifest.stages:
        raise ModelMismatch(f"{path}: stages {stages}, manifest {manifest.stages}")
    labels = next((list(map(list, s.labelsArray)) for s in model.stages if hasattr(s, "labelsArray")), [])
    if labels != list(manifest.label_maps.values()):
        raise ModelMismatch(f"{path}: the encoder's labels differ from the manifest's")
    return model, manifest
