"""Pandas UDFs that are made when they are first used, as a type's name can only be
read with a session, and what Arrow functions share."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: Bytes in an Arrow batch that goes to a Python worker, where the session leaves
#: Spark's default.  It bounds the memory of a task outside the heap, however long
#: the texts are.
BATCH_BYTES = 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_BYTES`` unless it sets a bound of
    its own."""
    name, default = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
    if spark.conf.get(name, default) == default:
        spark.conf.set(name, str(BATCH_BYTES))


def batched(df: DataFrame) -> DataFrame:
    """``df``, in whose session Arrow batches are bounded."""
    bound_batches(df.sparkSession)
    return df


def arrow_schema(kind: str | StructType) -> pa.Schema:
    """The Arrow schema of a Spark schema or its text."""
    return to_arrow_schema(StructType.fromDDL(kind) if isinstance(kind, str) else kind)


def pandas_udf(kind: str) -> Callable[[Callable], Callable[..., Column]]:
    """As Spark's decorator of this name."""

    def wrap(f: Callable) -> Callable[..., Column]:
        def use(*columns: Column | str) -> Column:
            bound_batches(SparkSession.active())
            return F.pandas_udf(f, kind)(*columns)

        use.__name__, use.__doc__ = f.__name__, f.__doc__
        return use

    return wrap
