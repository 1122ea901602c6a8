"""Small literal tables."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal(spark: SparkSession, rows: Sequence[Sequence], schema: str | T.StructType) -> DataFrame:
    """Rows given in code as a local relation.

    From Arrow, Spark keeps a small table inside the plan and knows its size, so joins with it
    broadcast by Spark's own threshold; a list of tuples would be an RDD of unknown size.
    """
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    fields = list(to_arrow_schema(struct))
    columns = [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, names=struct.fieldNames()), struct)
