"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkfold.session import scratch_path

#: Upper bound of the bytes that ``bounded_broadcast`` sends to every executor.
BROADCAST_BYTES = 64 << 20


def settled(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage with a table that survives lost executors, and fixes
    values that a recomputation could change (partition numbers)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _width(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value as Spark holds it in a row, measured."""
    if isinstance(kind, (T.StringType, T.BinaryType)):
        size = F.octet_length(value) + 16
    elif isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.ArrayType, T.StructType)):
            size = F.aggregate(value, F.lit(24).cast("long"), lambda total, x: total + _width(x, kind.elementType))
        else:
            size = F.size(value) * 8 + 24
    elif isinstance(kind, T.StructType):
        size = F.lit(16).cast("long")
        for field in kind.fields:
            size = size + _width(value.getField(field.name), field.dataType)
    else:
        return F.lit(8).cast("long")
    return F.coalesce(size.cast("long"), F.lit(8).cast("long"))


def measured_bytes(df: DataFrame) -> int:
    """Bytes of all rows of ``df`` (a ``settled`` table), each with 32 bytes of its own."""
    width = F.lit(32).cast("long")
    for field in df.schema.fields:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.sum(width)).first()[0] or 0


def bounded_broadcast(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if its rows are measured to hold at most ``most`` bytes, else ``df`` itself (the join then shuffles).

    ``df`` should be a ``settled`` table: the measure reads it."""
    return F.broadcast(df) if measured_bytes(df) <= most else df


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores appended until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
