"""Validation of JSON scoring requests against the fixed request schemas."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspan.schema import request_schema

CORRUPT = "_corrupt"


def validate(df: DataFrame, market: str, body: str = "value") -> tuple[DataFrame, DataFrame]:
    """(typed requests, rejected bodies). A body is rejected if it is not JSON, if a field has another
    type than declared, or if a field is missing or null; nothing is coerced. Other columns of `df` are
    kept on both sides."""
    fields = request_schema(market)
    read_as = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("_r", F.from_json(F.col(body), read_as, options))
    complete = reduce(
        lambda a, b: a & b, (F.col(f"_r.{f.name}").isNotNull() for f in fields), F.col(f"_r.{CORRUPT}").isNull()
    )
    kept = [c for c in df.columns if c != body]
    good = parsed.where(complete).select(*kept, *[f"_r.{f.name}" for f in fields])
    rejects = parsed.where(~complete).select(*kept, body)
    return good, rejects
