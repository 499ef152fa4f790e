"""Small fixed tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_rows(
    spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str
) -> DataFrame:
    """A frame of constants: configuration, rule lists, unknown members."""
    kinds = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not rows:
        return spark.createDataFrame([], kinds)
    built = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kinds.fields)])
        for row in rows
    ]
    return spark.range(1).select(F.inline(F.array(*built)))
