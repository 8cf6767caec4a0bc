"""Scoring pipelines (X1-X6): fit-time state -> raw input + pred_prob + pred_class.

`transform` is a stateless projection (no action), so it also runs on a streaming DataFrame.
Features are derived under a private prefix and dropped at the end; raw columns pass untouched.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.functions.columns import named
from quarry.operators.prep import FittedPrep

PREFIX = "__f_"


def _prefixed(prep: FittedPrep) -> FittedPrep:
    p = PREFIX
    return FittedPrep(
        numeric=[p + c for c in prep.numeric], nominal=[p + c for c in prep.nominal],
        log_cols=[p + c for c in prep.log_cols],
        level_maps={p + c: m for c, m in prep.level_maps.items()},
        means={p + c: v for c, v in prep.means.items()}, modes={p + c: v for c, v in prep.modes.items()},
        flags=[p + c for c in prep.flags], levels={p + c: v for c, v in prep.levels.items()})


@dataclass
class ScoringPipeline:
    prep: FittedPrep
    features: list[str]                 # feature columns (names as produced by `prep`)
    kind: str                           # "logit", "forest" (bagged trees), "network" or "spark" (a saved Spark ML model)
    cutoff: float = 0.5
    strict: bool = False                # class = prob > cutoff (strict) or >= cutoff
    intercept: float = 0.0
    coefs: dict[str, float] = field(default_factory=dict)
    model: object = None                # bagging.Forest, network.Network or fitted Spark ML model
    scale: dict[str, list[float]] = field(default_factory=dict)   # feature -> [mean, sd] before the model

    def transform(self, df: DataFrame) -> DataFrame:
        raw = df.columns
        needed = sorted(set(self.prep.numeric) | set(self.prep.nominal))
        work = df.select("*", *[named(c).alias(PREFIX + c) for c in needed])
        work = _prefixed(self.prep).transform(work)
        feats = [PREFIX + c for c in self.features]
        for c, (m, sd) in self.scale.items():
            work = work.withColumn(PREFIX + c, (F.col(PREFIX + c) - F.lit(m)) / F.lit(sd if sd else 1.0))
        if self.kind == "logit":
            coefs = {PREFIX + c: b for c, b in self.coefs.items()}
            prob = fc.sigmoid(fc.linear_predictor(coefs, self.intercept))
            work = work.withColumn("pred_prob", prob)
        elif self.kind == "forest":
            inputs = [named(PREFIX + c) for c in self.model.inputs.names]
            work = self.model.transform(work.select(*map(named, raw), *inputs), "pred_prob", PREFIX)
        elif self.kind == "network":
            inputs = [named(PREFIX + c) for c in self.model.inputs]
            work = self.model.transform(work.select(*map(named, raw), *inputs), "pred_prob", PREFIX)
        else:
            vec = PREFIX + "vec"
            work = VectorAssembler(inputCols=feats, outputCol=vec, handleInvalid="keep").transform(work)
            model = self.model.copy()
            model.setFeaturesCol(vec)
            for setter, name in (("setPredictionCol", "pred"), ("setProbabilityCol", "prob"),
                                 ("setRawPredictionCol", "raw")):
                if hasattr(model, setter):
                    getattr(model, setter)(PREFIX + name)
            if hasattr(model, "setLeafCol"):
                model.setLeafCol("")
            work = model.transform(work).withColumn("pred_prob", vector_to_array(PREFIX + "prob")[1])
        work = work.withColumn("pred_class", fc.cutoff_class("pred_prob", self.cutoff, self.strict))
        return work.select(*map(named, raw), "pred_prob", "pred_class")

    # ---- persistence (storage-agnostic: written through Spark) -----------------------------
    def params_json(self) -> str:
        return json.dumps({"prep": json.loads(self.prep.to_json()), "features": self.features, "kind": self.kind,
                           "cutoff": self.cutoff, "strict": self.strict, "intercept": self.intercept,
                           "coefs": self.coefs, "scale": self.scale, "model_class": type(self.model).__name__ if self.model else None})
