"""Parquet tables of a folder, and small tables given as literals."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def literal_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """Rows given in the program as a local relation, whose true size Catalyst knows."""
    kind = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kind)
    columns = [pa.array([r[i] for r in rows], arrow.field(i).type) for i in range(len(kind))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), kind)
