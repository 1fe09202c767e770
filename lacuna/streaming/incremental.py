"""The same operators over a folder that keeps receiving files.

Two streams can be ingested.  ``stream_lines`` is a stream of lines.  ``stream_files`` is one
of files: each batch is a listing with sizes, and what it lists is read as a batch job reads
it, so one file that holds most of a batch is dealt out to all cores, others are not moved.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lacuna.operators.profile import VALUE_FIELDS, profile_facts
from lacuna.sinks.files import check_outputs, parquet_name, place, remove, staging, write_parquet_parts
from lacuna.sources.inputs import Inputs, Listing, hadoop_path, key_of, qualified
from lacuna.sources.ndjson import parse_objects, scan_lines

_FILES = "path string, modificationTime timestamp, length bigint, content binary"
_COUNTERS = ("objects", "present", "null", "empty")
#: Batches that may lie beside one another before their facts are merged.
COMPACT_EVERY = 100


def stream_files(spark: SparkSession, folder: str, files_per_batch: int = 1000) -> DataFrame:
    """``path, length, root`` of each new file, once; nothing of a file is read.

    ``root`` is where the keys of the files start: the folder, or its part before a pattern.
    """
    fixed = re.split(r"/[^/]*[*?\[{]", folder, maxsplit=1)[0]
    reader = spark.readStream.format("binaryFile").schema(_FILES).option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder).select("path", "length", F.lit(qualified(spark, fixed)).alias("root"))


def batch_listing(files: DataFrame) -> Listing:
    """The listing of one batch of ``stream_files``; at most ``files_per_batch`` rows."""
    rows = files.collect()
    root = rows[0].root if rows else ""
    sizes = [r.length for r in rows if r.path.endswith(".gz")]
    inputs = Inputs([r.path for r in rows], root)
    return Listing(inputs, sum(sizes), max(sizes, default=0), sorted({key_of(r.path, root) for r in rows}))


def _is_listing(stream: DataFrame) -> bool:
    return "path" in stream.columns and "value" not in stream.columns


def ingest(
    lines: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    folder: str,
    checkpoint: str,
) -> StreamingQuery:
    """Transform new lines and append them as ZSTD Parquet; every file exactly once.

    Takes what has arrived and stops; started again with the same checkpoint it
    goes on where it ended.

    Lines of ``stream_lines`` are appended by Spark's own sink.  Of ``stream_files`` each batch
    is read with its large files dealt out, and its rows, which must keep ``file_name``, are
    placed under the names of their inputs (``lacuna.sinks.files``); a batch that is run again
    replaces them.
    """
    if _is_listing(lines):
        return _ingest_files(lines, transform, folder, checkpoint)
    table = transform(lines)
    if "file_name" in table.columns:
        table = table.withColumn("file_name", parquet_name(F.col("file_name")))
    writer = (
        table.writeStream.format("parquet")
        .option("path", folder)
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    if "file_name" in table.columns:
        writer = writer.partitionBy("file_name")
    return writer.start()


def _ingest_files(
    files: DataFrame, transform: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str
) -> StreamingQuery:
    def write_batch(batch: DataFrame, _: int) -> None:
        spark, found = batch.sparkSession, batch_listing(batch)
        if not found.inputs:
            return
        check_outputs(found.names, ".parquet")
        run = staging(folder)
        write_parquet_parts(transform(scan_lines(spark, found)), run)
        place(spark, run, folder, found.names, ".parquet")
        remove(spark, run)

    return _started(files, write_batch, checkpoint)


def _started(stream: DataFrame, write_batch: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    writer = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def ingest_profile(
    lines: DataFrame,
    folder: str,
    checkpoint: str,
    value_fields: Sequence[str] = VALUE_FIELDS,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """Append the profile facts of each batch of new files (``stream_lines`` or ``stream_files``).

    Facts add up, so nothing has to be kept between batches: there is no state
    store to grow with the number of values.  A batch that is run again after a
    failure replaces its own folder.  A new checkpoint would number its batches from 0
    again and replace the facts of others, so it is refused in a folder that has some.

    When more than ``compact_every`` batches lie beside one another, all before the current
    one are merged (``compact_profile``).
    """
    spark = lines.sparkSession
    if FactsFolder.read(spark, folder).paths() and not _exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{folder} has batches of another checkpoint than {checkpoint}")
    of_files = _is_listing(lines)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        if batch_id <= FactsFolder.read(spark, folder).upto:
            return  # merged already, from the same files
        if of_files:
            found = batch_listing(batch)
            if not found.inputs:
                return
            batch = scan_lines(batch.sparkSession, found)
        facts = profile_facts(parse_objects(batch), value_fields)
        facts.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")
        # The current batch may be run again; those before it are done.
        if len(FactsFolder.read(spark, folder).batches) > compact_every:
            compact_profile(spark, folder, batch_id - 1)

    return _started(lines, write_batch, checkpoint)


def _exists(spark: SparkSession, path: str) -> bool:
    found, system = hadoop_path(spark, path)
    return system.exists(found)


@dataclass
class FactsFolder:
    """The facts that count: the last whole generation and the batches after it.

    ``generation=7/`` has the merged facts of the batches up to 7.  It counts from the moment
    its ``_SUCCESS`` file is there, which Spark writes last: that is the switch.  What it
    replaces stays until the next one is whole, for reports that are being read meanwhile.
    """

    folder: str
    upto: int  # -1 without a generation
    batches: list[int]
    replaced: list[str]

    @classmethod
    def read(cls, spark: SparkSession, folder: str) -> FactsFolder:
        path, system = hadoop_path(spark, folder)
        names = [x.getPath().getName() for x in system.listStatus(path)] if system.exists(path) else []
        found = {"batch": [], "generation": []}
        for name in names:
            if match := re.fullmatch(r"(batch|generation)=([0-9]+)", name):
                found[match[1]].append(int(match[2]))
        whole = [n for n in found["generation"] if _exists(spark, f"{folder}/generation={n}/_SUCCESS")]
        upto = max(whole, default=-1)
        replaced = [f"generation={n}" for n in whole if n < upto] + [f"batch={n}" for n in found["batch"] if n <= upto]
        return cls(folder, upto, sorted(n for n in found["batch"] if n > upto), replaced)

    def paths(self, upto: int | None = None) -> list[str]:
        """What to read, of batches up to a number."""
        last = [f"{self.folder}/generation={self.upto}"] if self.upto >= 0 else []
        return last + [f"{self.folder}/batch={n}" for n in self.batches if upto is None or n <= upto]


def compact_profile(spark: SparkSession, folder: str, upto: int) -> None:
    """Merge the facts of all batches up to a number into one generation.

    Reports are the same before, while and after this runs.  If it fails, nothing has changed,
    and the next attempt writes over what it left.  Batches up to ``upto`` must be committed:
    one that is run again afterwards is passed over.  Folders that an earlier generation had
    replaced are removed.
    """
    before = FactsFolder.read(spark, folder)
    if upto <= before.upto or not before.paths(upto):
        return
    facts = spark.read.parquet(*before.paths(upto)).groupBy("file_name", "field", "value")
    merged = facts.agg(*[F.sum(c).alias(c) for c in _COUNTERS])
    merged.write.mode("overwrite").parquet(f"{folder}/generation={upto}")
    for name in before.replaced:
        remove(spark, f"{folder}/{name}")


def read_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The facts of all batches so far, ready for the profile reports."""
    found = FactsFolder.read(spark, folder).paths()
    if not found:
        raise ValueError(f"no batches in {folder}")
    return spark.read.parquet(*found)
