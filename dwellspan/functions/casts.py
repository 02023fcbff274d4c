"""Casts that turn raw listing columns into their declared types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dwellspan.schema import BOOL_COLUMNS, LISTING


def _accepts(field: T.StructField, given: T.DataType) -> Column | None:
    """Whether a value can be taken: whole numbers must be there, dates and flags may be missing, nothing may be garbled.
    None if every value can."""
    column = F.col(field.name)
    whole = isinstance(field.dataType, (T.IntegerType, T.LongType))
    if given == field.dataType:
        return column.isNotNull() if whole else None
    parsed = column.try_cast(field.dataType).isNotNull()
    return parsed if whole else column.isNull() | parsed


def refuse_uncastable(df: DataFrame, fields: list[T.StructField]) -> DataFrame:
    """`df`, after one pass over the columns in question that counts the values that can't be taken; any of them is an error.

    The pass comes first, on its own: whatever filters follow, also those that reach the scan and skip parts of files, every row
    has been looked at. A stream, which can't be passed over twice, is checked row by row as it comes."""
    checks = {f.name: ok for f in fields if (ok := _accepts(f, df.schema[f.name].dataType)) is not None}
    if not checks:
        return df
    shown = {n: F.coalesce(F.col(n).cast("string"), F.lit("null")) for n in checks}
    if df.isStreaming:
        stop = lambda n: F.raise_error(F.concat(F.lit(f"{n}: not castable: "), shown[n])).cast("boolean")
        return df.where(reduce(lambda a, b: a & b, [F.when(ok, True).otherwise(stop(n)) for n, ok in checks.items()]))
    counts = [F.count_if(~ok).alias(f"bad_{i}") for i, ok in enumerate(checks.values())]
    samples = [F.min(F.when(~ok, shown[n])).alias(f"like_{i}") for i, (n, ok) in enumerate(checks.items())]
    found = df.agg(*counts, *samples).first()
    bad = [
        f"{n}: not castable: {found[f'like_{i}']} ({found[f'bad_{i}']} rows)" for i, n in enumerate(checks) if found[f"bad_{i}"]
    ]
    if bad:
        raise ValueError("; ".join(bad))
    return df


def truthy(name: str, kind: T.DataType) -> Column:
    """Python truthiness: any non-empty string is true, a missing number is true, zero is false."""
    column = F.col(name)
    if isinstance(kind, T.StringType):
        return F.coalesce(column != "", F.lit(False))
    if isinstance(kind, T.BooleanType):
        return F.coalesce(column, F.lit(False))
    return F.coalesce(column != 0, F.lit(True))


def _required(df: DataFrame) -> list[T.StructField]:
    """Fields of `df` that carry a number, flag or time and so may fail to cast."""
    present = set(df.columns)
    return [
        f for f in LISTING.fields
        if f.name in present and not isinstance(f.dataType, T.StringType)
    ]


def cast_listing(df: DataFrame, strict_mode: bool = True, pandas_truthiness: bool = False) -> DataFrame:
    """Cast every listing column present in `df`. Strict mode looks at all rows first (a pass over a written table is cheap, over a
    long computation it is not) and stops on missing whole numbers and on values of any column that don't parse, whatever columns
    and rows are used later; otherwise they become null (see `split_castable`). A column that has its type already is left
    as it is, so filters on it reach the scan."""
    fields = _required(df)
    if strict_mode:
        df = refuse_uncastable(df, [f for f in fields if not (f.name in BOOL_COLUMNS and pandas_truthiness)])
    casts = {}
    for field in fields:
        name, given = field.name, df.schema[field.name].dataType
        if name in BOOL_COLUMNS and pandas_truthiness:
            casts[name] = truthy(name, given)
        elif given != field.dataType:
            casts[name] = F.col(name).try_cast(field.dataType)
    return df.withColumns(casts)


def split_castable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(typed rows, raw rows of which some number, flag or time is missing or does not parse)."""
    fields = _required(df)
    good = reduce(
        lambda a, b: a & b, (F.col(f.name).try_cast(f.dataType).isNotNull() for f in fields), F.lit(True)
    )
    return cast_listing(df.where(good), strict_mode=False), df.where(~good)
