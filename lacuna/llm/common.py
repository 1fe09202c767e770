"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lacuna.scratch import new_folder

#: Words are runs of anything but these six characters.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, purpose: str, compression: str = "zstd") -> DataFrame:
    """The rows, written once to the shared folder and read back: a cut in the lineage
    that lost executors do not undo."""
    path = new_folder(frame.sparkSession, purpose)
    frame.write.option("compression", compression).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session, which are sized for the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def pieces(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch cut so that the texts of each piece have about ``most`` bytes (one row at least)."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def from_rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """A batch from row tuples."""
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
