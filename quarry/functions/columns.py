"""Column-expression helpers (all JVM-side built-ins; no Python per row)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Null tokens of the reference's CSV reads (fixed values).
NULL_TOKENS = (".", "NA", "", "?")


def named(column: str) -> Column:
    """The column of exactly this name; dots and back-ticks in it are part of the name."""
    return F.col("`" + column.replace("`", "``") + "`")


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Text cell -> NULL when it is one of the null tokens (after trimming)."""
    c = col_(c)
    return F.when(F.trim(c).isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def parse_number(c) -> Column:
    """Currency/grouped text such as ``$1,234.50`` -> double; junk -> NULL (ANSI-safe)."""
    return F.regexp_replace(col_(c), r"[$,]", "").try_cast("double")


def sentinel_null(c, sentinel=0) -> Column:
    """Value equal to the sentinel -> NULL."""
    return F.nullif(col_(c), F.lit(sentinel))


def below_null(c, floor=1) -> Column:
    """Value below `floor` -> NULL (range check)."""
    c = col_(c)
    return F.when(c >= F.lit(floor), c)


def level_map(c, mapping: Mapping, default=None) -> Column:
    """Recode by an explicit old -> new map; values outside the map -> `default` (NULL)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    out = F.create_map(*pairs)[col_(c)]
    return out if default is None else F.coalesce(out, F.lit(default))


def ordinal_rank(c, levels: Sequence) -> Column:
    """Ordered factor -> 1-based rank of its level; unknown -> NULL."""
    return level_map(c, {lv: i + 1 for i, lv in enumerate(levels)})


def hour_of_text(c, fmt: str = "HH:mm:ss") -> Column:
    """Hour of a time-of-day text; unparsable -> NULL."""
    return F.hour(F.try_to_timestamp(col_(c), F.lit(fmt)))


# Daypart of an hour (fixed values): morning 5-11, afternoon 12-16, evening 17-20, night 21-4.
DAYPARTS = (("M", 5, 11), ("A", 12, 16), ("E", 17, 20))
DAYPART_NIGHT = "N"
DAYPART_ORDER = ("M", "A", "E", "N")


def daypart(hour_col) -> Column:
    h = col_(hour_col)
    expr = None
    for label, lo, hi in DAYPARTS:
        cond = (h >= lo) & (h <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(h.isNotNull(), F.lit(DAYPART_NIGHT))


def weighted_score(cols: Sequence, weights: Sequence[float]) -> Column:
    """Sum of weight * column, e.g. (2/3)*excellent + (1/3)*good."""
    out = None
    for c, w in zip(cols, weights):
        term = F.lit(float(w)) * col_(c)
        out = term if out is None else out + term
    return out


def cutoff_class(prob, cutoff: float = 0.5, strict: bool = False) -> Column:
    """Class from a probability: ``prob > cutoff`` when strict, else ``prob >= cutoff``."""
    p = col_(prob)
    cond = p > F.lit(cutoff) if strict else p >= F.lit(cutoff)
    return F.when(p.isNull(), F.lit(None).cast("int")).when(cond, 1).otherwise(0)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear_predictor(coefs: Mapping[str, float], intercept: float = 0.0) -> Column:
    """intercept + sum(coef * column) for fixed (fitted or stored) coefficients."""
    z = F.lit(float(intercept))
    for name, b in coefs.items():
        z = z + F.lit(float(b)) * col_(name).cast("double")
    return z
