"""Fit-time preparation state shared by model fitting and scoring.

`FittedPrep` holds everything learned from training rows (means, modes, the missing-flag list,
dummy levels, optional log columns and level maps) keyed by column name, so scoring a new table
applies exactly the fit-time decisions (no re-derivation from the scored data).
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions import columns as fc
from quarry.functions.columns import named
from quarry.operators import impute, transforms


@dataclass
class FittedPrep:
    numeric: list[str]
    nominal: list[str]
    log_cols: list[str] = field(default_factory=list)
    level_maps: dict[str, dict] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str] = field(default_factory=dict)
    flags: list[str] = field(default_factory=list)
    levels: dict[str, list] = field(default_factory=dict)

    # ---- fitting -------------------------------------------------------------------------
    @classmethod
    def fit(cls, df: DataFrame, numeric: Sequence[str], nominal: Sequence[str], where: Column | None = None,
            log_cols: Sequence[str] = (), level_maps: dict | None = None,
            flag_candidates: Sequence[str] | None = None) -> "FittedPrep":
        prep = cls(list(numeric), list(nominal), list(log_cols), dict(level_maps or {}))
        base = prep._recode(df)
        src = base if where is None else base.filter(where)
        cand = list(flag_candidates) if flag_candidates is not None else list(numeric)
        # One aggregate for the flag list and the means.
        row = src.agg(*[F.max(named(c).isNull().cast("int")).alias(f"na|{c}") for c in cand],
                      *[F.avg(named(c)).alias(f"m|{c}") for c in numeric]).first()
        prep.flags = [c for c in cand if row[f"na|{c}"] == 1]
        prep.means = {c: row[f"m|{c}"] for c in numeric}
        if nominal:
            # One value-count table gives both the modes and the dummy levels (bounded level count).
            from quarry.operators.explore import MAX_LEVELS, value_counts
            vc = value_counts(src, nominal, value_type="string").withColumnRenamed("cnt", "n")
            if vc.groupBy("col_name").count().filter(F.col("count") > MAX_LEVELS).limit(1).count():
                raise ValueError(f"a nominal input has more than {MAX_LEVELS} levels")
            counts: dict[str, dict] = {c: {} for c in nominal}
            for r in vc.collect():
                counts[r["col_name"]][r["value"]] = r["n"]
            types = dict(df.dtypes)
            for c in nominal:
                if counts[c]:
                    mode = min(counts[c].items(), key=lambda kv: (-kv[1], kv[0]))[0]
                    prep.modes[c] = impute._cast_back(mode, types[c])
                prep.levels[c] = sorted(counts[c])
        return prep

    # ---- applying ------------------------------------------------------------------------
    def _recode(self, df: DataFrame) -> DataFrame:
        out = df
        for c, m in self.level_maps.items():
            out = out.withColumn(c, fc.level_map(c, m))
        if self.log_cols:
            out = transforms.log1p_columns(out, self.log_cols)
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        """Recode, flag (fit-time list), impute (by name), dummy-code: a narrow projection."""
        out = self._recode(df)
        out = transforms.add_missing_flags(out, self.flags)
        out = impute.apply_fill(out, {**self.means, **self.modes})
        out = transforms.add_dummies(out, self.levels, full_rank=True)
        return out

    # ---- model terms ---------------------------------------------------------------------
    def terms(self) -> dict[str, list[str]]:
        """Model terms -> feature columns; all dummies of one nominal input form one term."""
        t = {c: [c] for c in self.numeric}
        for c in self.flags:
            t[c + transforms.FLAG_SUFFIX] = [c + transforms.FLAG_SUFFIX]
        for c, lv in self.levels.items():
            t[c] = [transforms.dummy_name(c, v) for v in lv[1:]]
        return t

    def feature_columns(self, terms: Sequence[str] | None = None) -> list[str]:
        all_terms = self.terms()
        names = list(all_terms) if terms is None else list(terms)
        return [col for t in names for col in all_terms[t]]

    # ---- persistence ---------------------------------------------------------------------
    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @classmethod
    def from_json(cls, text: str) -> "FittedPrep":
        return cls(**json.loads(text))


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)
