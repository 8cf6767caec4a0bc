"""CSV scans with several null tokens and one-pass type inference; CSV sink.

Spark's CSV `nullValue` takes one token only, so every column is read as text, the tokens are
mapped to NULL, and the column types are decided by one aggregate that counts, per column, the
non-NULL cells failing a numeric cast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import NULL_TOKENS, null_tokens

DEFAULT_TOKENS = ("NA",)


# The reader's own null marker is set to a value that never occurs, so blank cells arrive as "" and
# only the listed tokens become NULL; blanks then become NULL only in columns typed numeric.
_QUOTING = {"quote": '"', "escape": '"'}  # a quote inside a quoted cell is written twice
_NO_NULL = "\u0001<none>\u0001"
# What every text that casts to double begins with. A failed cast throws inside Spark, which costs many times a
# parsed number, so text cells are told apart before it.
_NUMBER_START = r"(?i)^[\x00-\x20]*[-+]?(\.?[0-9]|inf|nan)"


def read_csv_text(spark: SparkSession, path: str, tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """All columns as strings with the null tokens turned into NULL (header row required)."""
    raw = (spark.read.option("header", True).option("inferSchema", False).option("mode", "PERMISSIVE")
           .options(**_QUOTING, multiLine=True).option("nullValue", _NO_NULL).csv(path))
    return raw.select(*[null_tokens(F.col(f"`{c}`"), tokens).alias(c) for c in raw.columns])


def infer_types(df: DataFrame) -> dict[str, str]:
    """Per column: 'bigint' when every non-NULL cell is an integer, 'double' when numeric, else 'string'."""
    aggs = []
    for c in df.columns:
        v = F.when(F.trim(F.col(f"`{c}`")) != "", F.col(f"`{c}`"))   # blanks count as missing here
        aggs += [F.count_if(v.isNotNull() & (~v.rlike(_NUMBER_START) | v.try_cast("double").isNull())).alias(f"d|{c}"),
                 F.count_if(v.isNotNull() & (~v.rlike(r"^\s*[-+]?\d+\s*$")
                                             | v.try_cast("bigint").isNull())).alias(f"l|{c}")]
    row = df.agg(*aggs).first()
    out = {}
    for c in df.columns:
        if row[f"l|{c}"] == 0:
            out[c] = "bigint"
        elif row[f"d|{c}"] == 0:
            out[c] = "double"
        else:
            out[c] = "string"
    return out


def read_csv(spark: SparkSession, path: str, tokens: Sequence[str] = NULL_TOKENS,
             types: dict[str, str] | None = None) -> DataFrame:
    """CSV -> typed DataFrame; `types` (name -> Spark type) skips inference. Junk cells -> NULL."""
    text = read_csv_text(spark, path, tokens)
    types = types or infer_types(text)
    return text.select(*[F.col(f"`{c}`").try_cast(types.get(c, "string")).alias(c) for c in text.columns])


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header row, no row names; one file per partition under `path`."""
    df.write.mode(mode).option("header", True).options(**_QUOTING).csv(path)
