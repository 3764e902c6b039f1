"""Helpers for operators that look at whole texts in Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Texts are worked on in groups of about this many bytes, so that the arrays made for
# them stay small. One text is never divided: a longer one forms its own group.
GROUP_BYTES = 1 << 20

# Texts are long, so fewer rows than usual travel in one Arrow batch.
BATCH_ROWS, _BATCH_SETTING = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> None:
    """Lower the session's Arrow batch size to what suits long texts."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING)) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, BATCH_ROWS)


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns that matter, as `row_id` and `text`. Where the id is a whole
    row with its text in it (see `with_rows`), the text is not sent a second time."""
    small_batches(df)
    kind = df.schema[id_col].dataType
    if isinstance(kind, StructType) and text_col == "text" and StructField("text", StringType()) in kind.fields:
        return df.select(F.col(id_col).alias("row_id"))
    return df.select(F.col(id_col).alias("row_id"), F.col(text_col).cast("string").alias("text"))


def output_schema(df: DataFrame, id_col: str, more: str) -> StructType:
    """`row_id` with the type of the id column, and the fields of `more`."""
    return StructType([StructField("row_id", df.schema[id_col].dataType), *StructType.fromDDL(more).fields])


def with_rows(df: DataFrame) -> DataFrame:
    """`df` with a column `whole` that holds the row. As an id it brings every column
    through an operator, whatever the columns are called."""
    if "whole" in df.columns:
        df, inner = df.withColumnRenamed("whole", "whole kept"), df
        return df.withColumn("whole", F.struct(*[F.col(f"`{'whole kept' if c == 'whole' else c}`").alias(c) for c in inner.columns]))
    return df.withColumn("whole", F.struct(*[F.col(f"`{c}`") for c in df.columns]))


# Fixed values of the C library: parameters that bound what is mapped, and what is given back.
_TRIM_THRESHOLD, _MMAP_THRESHOLD = -1, -3
_KEPT_BYTES = 64 << 20


def reuse_memory() -> None:
    """Let this worker use freed memory again for arrays of up to 64 MB.

    By default every array of over 128 KB is mapped anew and touched page by page, which
    took half of the time of the byte-wise numpy code here. Other C libraries are left
    as they are."""
    try:
        set_option = ctypes.CDLL(None).mallopt
    except (OSError, AttributeError):
        return
    set_option(_MMAP_THRESHOLD, _KEPT_BYTES)
    set_option(_TRIM_THRESHOLD, 2 * _KEPT_BYTES)


def text_groups(
    batches: Iterator[pa.RecordBatch], limit: int = GROUP_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices of the batches with about `limit` bytes of `text`, and the texts as UTF-8."""
    reuse_memory()
    for batch in batches:
        at = batch.schema.get_field_index("text")
        column = batch.column(at) if at >= 0 else pc.struct_field(batch.column("row_id"), "text")
        column = column.cast(pa.binary())
        start = size = 0
        for i, more in enumerate(pc.binary_length(column).fill_null(0).to_pylist()):
            if i > start and size + more > limit:
                yield batch.slice(start, i - start), column.slice(start, i - start).to_pylist()
                start, size = i, 0
            size += more
        if start < len(column):
            yield batch.slice(start), column.slice(start).to_pylist()
