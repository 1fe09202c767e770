"""Writing results: outputs under the names of their inputs, or one document.

Rows that carry ``file_name`` go to a folder per name, as partitioned writers do.  The
programs then place the files of each input under its own name, ``out/day=1/part-0.gz``:
renames, no copies.  An input that several tasks wrote has further parts beside it,
``part-0.gz~0001.gz``, which the scan counts as the same input.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from lacuna.operators.profile import distribution_document
from lacuna.sources.inputs import hadoop_path, key_column, qualified

#: Renames that are asked for at a time.
RENAMES = 16


def exists(spark: SparkSession, path: str) -> bool:
    found, system = hadoop_path(spark, path)
    return system.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    found, system = hadoop_path(spark, path)
    system.delete(found, True)


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder, in order; none if there is no such folder."""
    path, system = hadoop_path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(x.getPath().getName() for x in system.listStatus(path) if x.isFile())


def has_parts(spark: SparkSession, folder: str) -> bool:
    """Whether a run has written rows of any input to the folder."""
    path, system = hadoop_path(spark, f"{folder}/file_name=*")
    return bool(system.globStatus(path))


def staging(folder: str) -> str:
    """A folder beside the outputs for what a run has not placed yet; readers pass over it."""
    return f"{folder}/_run-{uuid.uuid4().hex}"


def output_name(key: str, extension: str) -> str:
    """The file an input's output is placed at: ``.gz`` is replaced, or the extension added."""
    return key.removesuffix(".gz") + extension


def check_outputs(keys: Iterable[str], extension: str) -> None:
    """Raise if two inputs (``x`` and ``x.gz``) would have one output."""
    seen: dict[str, str] = {}
    for key in keys:
        if (other := seen.setdefault(output_name(key, extension), key)) != key:
            raise ValueError(f"inputs with one output: {other}, {key}")


def place(spark: SparkSession, written: str, folder: str, keys: Iterable[str], extension: str) -> None:
    """Move what was written under ``written/file_name=<key>/`` to the outputs of the inputs.

    Exactly the outputs of ``keys`` are replaced; an input without a row has none after it.
    Only names pass through the driver.  A run that ends half way leaves whole outputs, old
    or new ones, and is to be repeated.
    """
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    targets: dict[str, dict[str, str]] = {}
    for key in keys:
        parent, _, name = f"{folder}/{output_name(key, extension)}".rpartition("/")
        targets.setdefault(parent, {})[name] = key

    def one_folder(parent: str) -> None:
        names = targets[parent]
        for old in _listed(spark, parent):
            if re.sub(r"~[0-9]{4,}" + re.escape(extension) + "$", "", old) in names:
                remove(spark, f"{parent}/{old}")
        made, system = hadoop_path(spark, parent)
        for name, key in names.items():
            source = f"{written}/file_name={escape.escapePathName(key)}"
            parts = [x for x in _listed(spark, source) if not x.startswith(("_", "."))]
            if parts:
                system.mkdirs(made)
            for i, part in enumerate(parts):
                target = f"{parent}/{name}" if i == 0 else f"{parent}/{name}~{i:04}{extension}"
                if not system.rename(hadoop_path(spark, f"{source}/{part}")[0], hadoop_path(spark, target)[0]):
                    raise OSError(f"cannot place {source}/{part} at {target}")

    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(one_folder, targets))


def read_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of placed Parquet outputs, with ``file_name``; folders below are read, too."""
    rows = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    return rows.withColumn("file_name", key_column(F.col("_metadata.file_path"), qualified(spark, folder)))


def write_clean_lines(cleaned: DataFrame, folder: str) -> None:
    """Cleaned records as gzip NDJSON under ``file_name=<input name>/``.

    No shuffle: a task writes the lines it cleaned, so a large input gives
    several parts under its name rather than one slow one.
    """
    lines = cleaned.select("file_name", F.col("cleaned").alias("value")).where("value IS NOT NULL")
    writer = lines.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("file_name").option("compression", "gzip").text(folder)


def write_clean_and_counts(kinds: DataFrame, folder: str) -> None:
    """The rows of ``clean_with_counts`` in one pass: lines under ``kind=lines/``, counters
    under ``kind=counts/``, rejected lines under ``kind=rejects/``."""
    kinds.write.partitionBy("kind", "file_name").option("compression", "gzip").text(folder)


def parquet_name(file_name: Column) -> Column:
    """Output name of an input: ``part-0.gz`` gives ``part-0.parquet``."""
    return F.replace(file_name, F.lit(".gz"), F.lit(".parquet"))


def write_rejects(judged: DataFrame, folder: str) -> None:
    """Rejected lines after their reason, gzip, under ``file_name=<input name>/``."""
    line = F.concat_ws(" ", "reason", F.make_valid_utf8("value")).alias("value")
    lines = judged.where("reason IS NOT NULL").select("file_name", line)
    lines.write.partitionBy("file_name").option("compression", "gzip").text(folder)


def write_parquet(table: DataFrame, folder: str, zstd_level: int | None = None) -> None:
    """ZSTD Parquet; one sub-folder per input file if the rows carry ``file_name``."""
    if "file_name" in table.columns:
        table = table.withColumn("file_name", parquet_name(F.col("file_name")))
        writer = table.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("file_name")
    else:
        writer = table.write.mode("overwrite")
    _zstd(writer, zstd_level).parquet(folder)


def write_parquet_parts(table: DataFrame, folder: str, zstd_level: int | None = None) -> None:
    """ZSTD Parquet under ``file_name=<input name>/``, to be placed."""
    _zstd(table.write.partitionBy("file_name"), zstd_level).parquet(folder)


def _zstd(writer: DataFrameWriter, level: int | None) -> DataFrameWriter:
    if level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    return writer.option("compression", "zstd")


def write_lines(lines: DataFrame, folder: str, compression: str = "none") -> None:
    """The lines as they are."""
    lines.select("value").write.mode("overwrite").option("compression", compression).text(folder)


def write_value_distributions(counts: DataFrame, folder: str) -> None:
    """The long table under ``table/`` and the JSON document under ``document/``.

    The document's parts, read in name order, are one JSON object.  They are
    range-partitioned, so neither the driver nor one task holds all values.
    """
    counts.write.mode("overwrite").parquet(f"{folder}/table")
    table = counts.sparkSession.read.parquet(f"{folder}/table")
    document = distribution_document(table).orderBy("field", "value")
    document.select("text").write.mode("overwrite").text(f"{folder}/document")
