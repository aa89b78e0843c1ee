"""Report tables as CSV, multi-table bundles and model artefacts."""

from __future__ import annotations

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.boosting import BoostedModel, Tree
from ..operators.logistic import LogisticModel
from ..operators.scoring import PROBABILITY

BYTE_ORDER_MARK = "﻿"


def save_csv(df: DataFrame, path: str, single_file: bool = False) -> str:
    """UTF-8 CSV with header and byte-order mark.

    ``single_file`` funnels the rows through one task: only for reports known to be small.
    """
    first = df.columns[0]
    marked = df.withColumnRenamed(first, BYTE_ORDER_MARK + first)
    out = marked.coalesce(1) if single_file else marked
    out.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)
    return path


def save_bundle(tables: dict[str, DataFrame], path: str, fmt: str = "parquet") -> dict[str, str]:
    """One sub-folder per table below ``path``."""
    out = {}
    for name, df in tables.items():
        target = f"{path.rstrip('/')}/{name}"
        if fmt == "csv":
            save_csv(df, target)
        else:
            df.write.mode("overwrite").format(fmt).save(target)
        out[name] = target
    return out


def save_model(model: PipelineModel | BoostedModel | LogisticModel, path: str) -> str:
    """A folder per model: Spark's own layout, or the rows of the library's models as Parquet next to their settings.

    A logistic model is also a Spark pipeline of one SQL stage, so ``PipelineModel.load`` scores with it without this library.
    """
    if isinstance(model, PipelineModel):
        model.write().overwrite().save(path)
        return path
    spark = SparkSession.active()
    if isinstance(model, BoostedModel):
        kind, schema = "boosted", "tree int, node int, feature string, threshold double, gain double, leaf double"
        edges = [[float(x) for x in e[np.isfinite(e)]] for e in model.edges]
        settings = [("boosted", list(model.features), edges, float(model.eta), None)]
    else:
        PipelineModel([SQLTransformer(statement=_logistic_sql(model))]).write().overwrite().save(path)
        kind, schema = "logistic", "feature string, coefficient double, mean double, deviation double"
        settings = [("logistic", list(model.features), None, None, [float(g) for g in model.gradient])]
    head = "kind string, features array<string>, edges array<array<double>>, eta double, gradient array<double>"
    spark.createDataFrame(settings, head).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
    spark.createDataFrame(model.rows(), schema).coalesce(1).write.mode("overwrite").parquet(f"{path}/{kind}")
    return path


def _logistic_sql(model: LogisticModel) -> str:
    number = lambda x: f"({float(x)!r}D)"
    terms = [
        f"(coalesce(nanvl(cast(`{c}` as double), 0D), 0D) - {number(m)}) * {number(w / s)}"
        for c, w, m, s in zip(model.features, model.coefficients, model.means, model.deviations)
    ]
    margin = " + ".join([number(model.intercept), *terms])
    return f"SELECT *, 1 / (1 + exp(-greatest(-35D, least(35D, {margin})))) AS {PROBABILITY} FROM __THIS__"


def load_model(spark: SparkSession, path: str) -> PipelineModel | BoostedModel | LogisticModel:
    """What ``save_model`` wrote; a model has few rows, whatever it was fitted on."""
    files = spark._jvm.org.apache.hadoop.fs.Path(path)
    settings = spark._jvm.org.apache.hadoop.fs.Path(path, "settings")
    if not files.getFileSystem(spark._jsc.hadoopConfiguration()).exists(settings):
        return PipelineModel.load(path)
    head = spark.read.parquet(f"{path}/settings").first()
    rows = spark.read.parquet(f"{path}/{head['kind']}").collect()
    if head["kind"] == "logistic":
        found = {r["feature"]: r for r in rows}
        column = lambda name: np.array([found[f][name] for f in head["features"]])
        return LogisticModel(tuple(head["features"]), found["intercept"]["coefficient"], column("coefficient"),
                             column("mean"), column("deviation"), np.array(head["gradient"]))
    width = max((len(e) for e in head["edges"]), default=0)
    edges = np.array([[*e, *[np.inf] * (width - len(e))] for e in head["edges"]])
    place = {f: i for i, f in enumerate(head["features"])}
    by_tree: dict[int, list] = {}
    for r in rows:
        by_tree.setdefault(r["tree"], []).append(r)
    trees = []
    for t in sorted(by_tree):
        nodes = sorted(by_tree[t], key=lambda r: r["node"])
        inner = [r for r in nodes if r["leaf"] is None]
        bins = [np.searchsorted(edges[place[r["feature"]]], r["threshold"]) if r["threshold"] is not None else 255 for r in inner]
        trees.append(Tree(np.array([place[r["feature"]] for r in inner]), np.array(bins), np.array([r["gain"] for r in inner]),
                          np.array([r["leaf"] for r in nodes if r["leaf"] is not None])))
    return BoostedModel(tuple(head["features"]), edges, trees, head["eta"])


def prediction_name(label: str) -> str:
    """Name of the scored list for a ``YYYY-Qn`` quarter."""
    return f"churn_predictions_snapshot_{label.replace('-', '')}"


def latest_label(fact: DataFrame) -> str:
    order = F.struct("Year", "Quarter_Num")
    return fact.agg(F.max_by("Year_Quarter", order)).first()[0]
