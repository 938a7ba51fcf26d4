"""Feature vectors and their array form."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def assembler(features, on_invalid: str = "error", output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid=on_invalid)


def assemble(df: DataFrame, features, on_invalid: str = "error", output: str = "features") -> DataFrame:
    """Add a vector column. ``on_invalid`` is ``error``, ``skip`` or ``keep`` (NULL becomes NaN)."""
    return assembler(features, on_invalid, output).transform(df)


def features_array(vector: str = "features") -> Column:
    """Vector column as ``array<double>``, evaluated in the JVM."""
    return vector_to_array(F.col(vector))


def feature_columns(df: DataFrame, exclude) -> list[str]:
    """Columns left after ``exclude``, in table order."""
    barred = set(exclude)
    return [c for c in df.columns if c not in barred]


def with_arrays(df: DataFrame) -> DataFrame:
    """For every vector column ``v`` a column ``v_array``, for SQL text to select from.

    Spark's own conversion runs in the JVM and has no name in SQL text. A NULL vector stays NULL.
    """
    vectors = [f.name for f in df.schema if isinstance(f.dataType, VectorUDT)]
    arrays = {f"{name}_array": F.when(F.col(name).isNotNull(), features_array(name)) for name in vectors}
    return df.withColumns(arrays)
