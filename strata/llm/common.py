"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


def quoted(name: str) -> str:
    """A column name safe for ``F.col``: dots and backticks are part of the name."""
    return "`" + name.replace("`", "``") + "`"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder of the session, and read again.

    It cuts the lineage: what is lost with an executor is read again rather
    than computed again, and branches that share ``df`` don't repeat it.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that no plan reads any more: all that was made of them is written itself."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir (a scratch folder in local sessions without it)."""
    return ensure_checkpoint_dir(spark).rstrip("/")


def settled(column: Column) -> Column:
    """``column``, computed once per row at this place of the plan.

    The optimizer moves a filter on a result below the projections that make
    it and so puts whole expressions inside the lambdas that read them, to be
    computed again for every element. It leaves expressions that look
    non-deterministic where they are; this condition is always true.
    """
    return F.when(F.monotonically_increasing_id() >= 0, column)


def extended(df: DataFrame, ddl: str) -> T.StructType:
    """The schema of ``df`` with more fields."""
    return T.StructType([*df.schema.fields, *T.StructType.fromDDL(ddl).fields])


def map_rows(df: DataFrame, column: str, ddl: str,
             run: Callable[[str], Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]]) -> DataFrame:
    """``df`` with the columns of ``ddl``, which ``run(name of column)`` appends to its batches.

    Columns of the same names are replaced. The batches carry place names
    (c0, c1, ...), so any column name of ``df`` will do.
    """
    added = T.StructType.fromDDL(ddl).names
    kept = df.select(*[F.col(quoted(c)) for c in df.columns if c.lower() not in added])
    names = kept.columns
    plain = kept.toDF(*[f"c{i}" for i in range(len(names))])
    return plain.mapInArrow(run(f"c{names.index(column)}"), extended(plain, ddl)).toDF(*names, *added)


def row_keys(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, k1, k2) of every row: rows of equal id and text share the 128-bit key, others don't.

    Results found per key are joined back to all rows that hold it, so no row
    needs a number of its own.
    """
    rows = docs.select(F.col(quoted(doc_id)).alias("doc_id"), F.col(quoted(text)).alias("text"))
    return rows.select("*", F.xxhash64("doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"))
