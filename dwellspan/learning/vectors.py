"""Feature columns to ML vectors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    """Dense vector of the features in the given order, flags as 0 and 1; a null is an error."""
    numbers = {f"_f{i}": F.col(f"`{c}`").cast("double") for i, c in enumerate(features)}
    assembler = VectorAssembler(inputCols=list(numbers), outputCol=output, handleInvalid="error")
    return assembler.transform(df.withColumns(numbers)).drop(*numbers)
