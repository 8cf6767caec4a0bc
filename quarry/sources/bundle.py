"""Save / load a scoring bundle: parameters as JSON text and the Spark ML model, both written
through Spark so the folder can live on any shared file system (S4, S5)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from quarry.operators.bagging import Forest
from quarry.operators.network import Network
from quarry.operators.prep import FittedPrep
from quarry.operators.scoring import ScoringPipeline


def save_bundle(spark: SparkSession, pipe: ScoringPipeline, path: str) -> None:
    spark.createDataFrame([(pipe.params_json(),)], "params string").coalesce(1).write.mode(
        "overwrite").text(f"{path}/params")
    if pipe.kind in ("forest", "network"):
        pipe.model.save(spark, f"{path}/model")
    elif pipe.model is not None:
        pipe.model.write().overwrite().save(f"{path}/model")


def load_bundle(spark: SparkSession, path: str) -> ScoringPipeline:
    text = spark.read.text(f"{path}/params").first()[0]
    p = json.loads(text)
    model = None
    if p["kind"] == "forest":
        model = Forest.load(spark, f"{path}/model")
    elif p["kind"] == "network":
        model = Network.load(spark, f"{path}/model")
    elif p["model_class"]:
        import pyspark.ml.classification as cls
        import pyspark.ml.regression as reg
        klass = getattr(cls, p["model_class"], None) or getattr(reg, p["model_class"])
        model = klass.load(f"{path}/model")
    prep = FittedPrep.from_json(json.dumps(p["prep"]))
    return ScoringPipeline(prep=prep, features=p["features"], kind=p["kind"], cutoff=p["cutoff"],
                           strict=p["strict"], intercept=p["intercept"], coefs=p["coefs"], model=model,
                           scale={k: list(v) for k, v in p.get("scale", {}).items()})
