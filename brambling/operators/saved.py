"""Fitted models on disk.

A model is a folder that Spark can reach: its tables as Parquet, models of ``pyspark.ml`` as these
write themselves, models that it consists of in folders below, and ``manifest``, one line of JSON with
the layout's version, the kind of model and its numbers. The manifest comes last, so a folder left by a
broken-off write holds no model. Tables keep doubles bit by bit, so a loaded model predicts what the
saved one does.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession

from brambling.operators.categories import CategoryIndex, Layout
from brambling.operators.forest import ForestClassifier
from brambling.operators.logistic import LogisticModel
from brambling.operators.neighbours import TextClassifier
from brambling.operators.text_features import Dictionary, Scaler, TextModel

LAYOUT = 1


@dataclass(frozen=True)
class Content:
    """What a model consists of."""

    tables: dict[str, DataFrame]
    numbers: dict[str, Any]
    models: dict[str, Any]


@dataclass(frozen=True)
class Kind:
    """How a model is taken apart and put together again."""

    model: type
    take: Callable[[Any], Content]
    build: Callable[[Content], Any]


def _theta(model: LogisticModel) -> DataFrame:
    table = pa.table({"rank": pa.array(np.arange(len(model.theta))), "theta": pa.array(model.theta)})
    return model.scaler.table.sparkSession.createDataFrame(table)


def _theta_of(table: DataFrame) -> np.ndarray:
    """One number per word of a dictionary."""
    found = table.toArrow()
    out = np.zeros(found.num_rows)
    out[found.column("rank").to_numpy()] = found.column("theta").to_numpy()
    return out


def _dictionary(c: Content) -> Dictionary:
    return Dictionary(c.tables["dictionary"], c.numbers["size"], c.numbers["nbytes"], c.numbers["n_docs"])


KINDS = (
    Kind(
        TextModel,
        lambda m: Content({"dictionary": m.dictionary.table, "idf": m.idf}, {"size": m.dictionary.size, "nbytes": m.dictionary.nbytes, "n_docs": m.dictionary.n_docs}, {}),
        lambda c: TextModel(_dictionary(c), c.tables["idf"]),
    ),
    Kind(
        Dictionary,
        lambda m: Content({"dictionary": m.table}, {"size": m.size, "nbytes": m.nbytes, "n_docs": m.n_docs}, {}),
        _dictionary,
    ),
    Kind(Scaler, lambda m: Content({"stats": m.table}, {"size": m.size, "shrink": m.shrink}, {}), lambda c: Scaler(c.tables["stats"], **c.numbers)),
    Kind(
        LogisticModel,
        lambda m: Content({"theta": _theta(m)}, {"loss": m.loss, "iterations": m.iterations, "rejected": m.rejected}, {"scaler": m.scaler}),
        lambda c: LogisticModel(_theta_of(c.tables["theta"]), scaler=c.models["scaler"], **c.numbers),
    ),
    Kind(TextClassifier, lambda m: Content({"vectors": m.vectors}, {}, {"model": m.model}), lambda c: TextClassifier(c.models["model"], c.tables["vectors"])),
    Kind(CategoryIndex, lambda m: Content({"categories": m.table}, {"size": m.size, "nbytes": m.nbytes}, {}), lambda c: CategoryIndex(c.tables["categories"], **c.numbers)),
    Kind(
        Layout,
        lambda m: Content({}, {"numeric": m.numeric, "categorical": list(m.categorical), "drop_last": m.drop_last}, {f"index-{k}": i for k, i in enumerate(m.categorical.values())}),
        lambda c: Layout(tuple(c.numbers["numeric"]), {name: c.models[f"index-{k}"] for k, name in enumerate(c.numbers["categorical"])}, c.numbers["drop_last"]),
    ),
    Kind(
        ForestClassifier,
        lambda m: Content({}, {}, {"forest": m.forest, "classes": m.classes, "layout": m.layout}),
        lambda c: ForestClassifier(c.models["forest"], c.models["classes"], c.models["layout"]),
    ),
)


def save(model: Any, path: str) -> None:
    """Write ``model`` to a folder that does not exist yet."""
    kind = next((k for k in KINDS if type(model) is k.model), None)
    if kind is None:
        raise TypeError(f"a {type(model).__name__} cannot be saved")
    content = kind.take(model)
    for name, table in content.tables.items():
        table.write.parquet(f"{path}/{name}")
    for name, part in content.models.items():
        if isinstance(part, RandomForestClassificationModel):
            part.save(f"{path}/{name}")
        else:
            save(part, f"{path}/{name}")
    manifest = {"layout": LAYOUT, "kind": kind.model.__name__, "numbers": content.numbers, "tables": list(content.tables)}
    manifest["models"] = {name: "spark" if isinstance(part, RandomForestClassificationModel) else "own" for name, part in content.models.items()}
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.text(f"{path}/manifest")


def load(spark: SparkSession, path: str, expected: type | None = None) -> Any:
    """The model at ``path``; an error if it is of another kind than ``expected``, or of another layout."""
    manifest = json.loads("".join(r.value for r in spark.read.text(f"{path}/manifest").collect()))
    if manifest["layout"] != LAYOUT:
        raise ValueError(f"{path} has layout {manifest['layout']}, and this version reads layout {LAYOUT}")
    kind = next((k for k in KINDS if k.model.__name__ == manifest["kind"]), None)
    if kind is None or expected not in (None, kind.model):
        raise TypeError(f"{path} holds a {manifest['kind']}")
    tables = {name: spark.read.parquet(f"{path}/{name}") for name in manifest["tables"]}
    models = {
        name: RandomForestClassificationModel.load(f"{path}/{name}") if how == "spark" else load(spark, f"{path}/{name}") for name, how in manifest["models"].items()
    }
    return kind.build(Content(tables, manifest["numbers"], models))
