"""Reports with their totals, and the outcome of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_total(report: DataFrame) -> DataFrame:
    """The rows of a report per file, and one of the sums of all its counters.

    ``total`` is true for that row, whose ``file_name`` is null; ``files`` is how many files a
    row stands for.  One aggregate over grouping sets: a file without a name stays apart.
    """
    counters = [c for c in report.columns if c != "file_name"]
    return report.rollup("file_name").agg(
        (F.grouping("file_name") == 1).alias("total"),
        F.count("*").alias("files"),
        *[F.sum(c).cast("long").alias(c) for c in counters],
    )


def outcome(status: DataFrame) -> DataFrame:
    """``successful, failed``: how many files a run has done and not done."""
    return status.agg(
        F.count_if("success").alias("successful"),
        F.count_if(~F.col("success")).alias("failed"),
    )
