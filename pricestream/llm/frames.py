"""How operators take and give back tables with any further columns."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricestream.session import ship_package

REST = "rest"
#: Bytes of an Arrow batch sent to a task's Python worker: rows hold whole documents.
BATCH_BYTES = "16m"


def prepare(spark: SparkSession) -> None:
    """Makes this package importable in Python workers and bounds the batches they get."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def carry(df: DataFrame, **named: str) -> DataFrame:
    """The columns an operator works on under its own names, all others in one struct;
    so a table's further columns may have any names."""
    others = [c for c in df.columns if c not in named.values()]
    rest = F.struct(F.lit(0).alias("__none"), *[F.col(f"`{c}`").alias(c) for c in others])
    return df.select(*[F.col(f"`{c}`").alias(n) for n, c in named.items()], rest.alias(REST))


def restore(df: DataFrame, columns: list[str], added: list[str], **named: str) -> DataFrame:
    """``columns`` of the table given to ``carry`` in their order, then ``added``. An added
    column replaces one of the same name."""
    back = {c: n for n, c in named.items()}
    out = [F.col(back[c]).alias(c) if c in back else F.col(REST).getField(c).alias(c)
           for c in columns if c not in added]
    return df.select(*out, *added)


def schema_of(df: DataFrame, *names: str, **more: str) -> T.StructType:
    """The named fields of ``df`` and further ones given as name=type."""
    fields = [df.schema[n] for n in names]
    return T.StructType(fields + T._parse_datatype_string(
        ", ".join(f"{k} {v}" for k, v in more.items())).fields if more else fields)


def table(**columns) -> pa.Table:
    return pa.table({k: v for k, v in columns.items()})
