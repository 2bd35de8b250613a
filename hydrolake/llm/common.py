"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import gc
import json
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructType

from hydrolake.session import scratch_path


#: Clears what a module keeps in a worker from task to task.
CACHES: list[Callable[[], None]] = []


def release() -> None:
    """Let go of what other operators left in this worker, which Spark hands from stage to stage."""
    for clear in CACHES:
        clear()
    gc.collect()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts lineage, and what is
    expensive is computed once. The files outlive lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """UTF-8 bytes of all texts; one number, to choose how many groups the work is dealt to."""
    return docs.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0


def parts(total: int, each: int, least: int = 1) -> int:
    """How many parts of about ``each`` a total needs."""
    return max(least, math.ceil(total / each))


def keyed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only the id (long) and the text (binary, UTF-8), so that further columns of any name
    neither clash nor travel."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"),
                       F.col(text).cast("string").cast("binary").alias("text"))


def free(df: DataFrame, stem: str) -> str:
    """A column name that the table lacks."""
    names = {c.lower() for c in df.columns}
    while stem.lower() in names:
        stem += "_"
    return stem


def nullable(schema: StructType) -> StructType:
    """The schema with null allowed everywhere, which Python functions return carried columns under."""
    text = schema.json()
    for name in ("nullable", "containsNull", "valueContainsNull"):
        text = text.replace(f'"{name}":false', f'"{name}":true')
    return StructType.fromJson(json.loads(text))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that one holds about ``most`` bytes of a text column (or one row)."""
    for batch in batches:
        n, size = batch.num_rows, batch.column(column).nbytes
        step = max(1, n if size <= most else n * most // size)
        for i in range(0, n, step):
            yield batch.slice(i, step)


def bucket(n: int, *cols: Column | str) -> Column:
    """A bucket from 0 to n - 1 by the hash of columns."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


