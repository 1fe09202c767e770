"""Token ids on disk: every document one zstandard frame, all with one trained dictionary.

The files hold blocks of documents in ascending ``doc_id`` order.  A block carries its
frames back to back, the offset of each, and the hash of the dictionary they need, so a
short document is read by decompressing its own frame and nothing else.  Blocks are rows
of Parquet: any store Spark writes to will do, and a lost task's files never count.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lacuna.llm.common import from_rows, partitions
from lacuna.llm.tokens import encoder

#: The dictionary is trained on at most so many documents of at most so many characters.
SAMPLE_DOCUMENTS, SAMPLE_CHARS, DICTIONARY_BYTES = 1000, 32 << 10, 64 << 10
BLOCK_BYTES, BLOCK_DOCUMENTS = 1 << 20, 1000
LEVEL = 3

BLOCKS = pa.schema(
    [
        ("part", pa.int32()),
        ("block", pa.int32()),
        ("dictionary", pa.string()),
        ("id_bytes", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.list_(pa.int64())),
        ("offsets", pa.list_(pa.int64())),
        ("frames", pa.large_binary()),
    ]
)
_BLOCKS_SQL = (
    "part int, block int, dictionary string, id_bytes int, doc_ids array<bigint>, "
    "n_tokens array<bigint>, offsets array<bigint>, frames binary"
)
_PLACE = [("doc_id", pa.int64()), ("part", pa.int32()), ("block", pa.int32()), ("at", pa.int64()), ("n_tokens", pa.int64())]
_PLACE_SQL = "doc_id bigint, part int, block int, at bigint, n_tokens bigint"


def _serialised(text: str | None, path: str, end_id: int) -> bytes:
    known = encoder(path)
    return known.bytes(text or "") + np.array([end_id], known.dtype).tobytes()


def train_dictionary(documents: DataFrame, path: str, end_id: int, doc_id: str, text: str) -> bytes:
    """A dictionary of the ids of a sample: of the ``SAMPLE_DOCUMENTS`` documents whose ids
    hash lowest, those of 1 to ``SAMPLE_CHARS`` characters, whole.  Empty (plain
    zstandard) if there is too little to train on."""
    rows = documents.select(F.col(f"`{doc_id}`").alias("i"), F.col(f"`{text}`").cast("string").alias("t"))
    lowest = rows.select("i").filter("i IS NOT NULL").orderBy(F.xxhash64("i"), "i").limit(SAMPLE_DOCUMENTS)
    chosen = [r.i for r in lowest.collect()]
    some = rows.filter(F.col("i").isin(chosen) & F.length("t").between(1, SAMPLE_CHARS)).select("t")
    samples = [_serialised(r.t, path, end_id) for r in some.limit(SAMPLE_DOCUMENTS).collect()]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _hash(dictionary: bytes) -> str:
    return hashlib.sha256(dictionary).hexdigest() if dictionary else ""


def _zdict(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


def write_tokens(
    documents: DataFrame,
    folder: str,
    tokenizer: str | None = None,
    end_id: int = 1,
    doc_id: str = "doc_id",
    text: str = "text",
) -> None:
    """Write ``folder/dictionary`` and ``folder/blocks``.

    A null text counts as empty (its ids are the end id alone); rows with equal ids stay
    apart and are ordered by text; null ids come first.  An empty table gives no blocks.
    Documents are dealt by ranges of ``doc_id`` (and the hash of the text, should one id
    be everywhere) before they are encoded, so each text is encoded once.
    """
    spark = documents.sparkSession
    path = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    dictionary = train_dictionary(documents, path, end_id, doc_id, text)
    name = _hash(dictionary)
    spark.createDataFrame([(name, bytearray(dictionary))], "hash string, dictionary binary").coalesce(1).write.mode(
        "overwrite"
    ).parquet(f"{folder}/dictionary")
    size = np.dtype(encoder(path).dtype).itemsize

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_zdict(dictionary))
        part, block, ids, counts, offsets, frames, total = -1, 0, [], [], [0], [], 0

        def done() -> pa.RecordBatch:
            return from_rows([(part, block, name, size, ids, counts, offsets, b"".join(frames))], BLOCKS)

        for batch in batches:
            for i, t, p in zip(*(batch.column(c).to_pylist() for c in ("i", "t", "p")), strict=True):
                part = p
                raw = _serialised(t, path, end_id)
                frame = compressor.compress(raw)
                ids.append(i)
                counts.append(len(raw) // size)
                frames.append(frame)
                total += len(frame)
                offsets.append(total)
                if total >= BLOCK_BYTES or len(ids) >= BLOCK_DOCUMENTS:
                    yield done()
                    block, ids, counts, offsets, frames, total = block + 1, [], [], [0], [], 0
        if ids:
            yield done()

    rows = documents.select(F.col(f"`{doc_id}`").alias("i"), F.col(f"`{text}`").cast("string").alias("t"))
    ranged = rows.withColumn("h", F.xxhash64("t")).repartitionByRange(partitions(spark), "i", "h")
    ordered = ranged.sortWithinPartitions("i", "h", "t").select("i", "t", F.spark_partition_id().alias("p"))
    ordered.mapInArrow(blocks, _BLOCKS_SQL).write.mode("overwrite").option("compression", "none").parquet(f"{folder}/blocks")


def _dictionaries(spark: SparkSession, folder: str) -> dict[str, bytes]:
    return {r.hash: bytes(r.dictionary) for r in spark.read.parquet(f"{folder}/dictionary").collect()}


def _reader(spark: SparkSession, folder: str, wanted: set | None, finish):
    """Batch function from blocks to (doc_id, part, block, at, n_tokens, ``finish``(ids)),
    the ids as little-endian 32-bit integers."""
    known = _dictionaries(spark, folder)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers: dict = {}
        for batch in batches:
            for row in batch.to_pylist():
                name = row["dictionary"]
                if name not in readers:
                    if _hash(known[name]) != name:
                        raise ValueError(f"the dictionary is not {name}")
                    readers[name] = zstandard.ZstdDecompressor(dict_data=_zdict(known[name]))
                before, out, size = 0, [], 0
                for k, (i, n) in enumerate(zip(row["doc_ids"], row["n_tokens"], strict=True)):
                    if wanted is None or i in wanted:
                        frame = row["frames"][row["offsets"][k] : row["offsets"][k + 1]]
                        ids = readers[name].decompress(frame)
                        if row["id_bytes"] == 2:
                            ids = np.frombuffer(ids, "<u2").astype("<u4").tobytes()
                        if len(ids) != 4 * n:
                            raise ValueError(f"document {i}: {len(ids) // 4} ids, not {n}")
                        out.append((i, row["part"], row["block"], before, n, finish(ids)))
                        size += len(ids)
                    before += n
                    if size >= 8 << 20:
                        yield from_rows(out, finish.schema)
                        out, size = [], 0
                yield from_rows(out, finish.schema)

    return read


class _Ids:
    """The ids themselves."""

    schema = pa.schema([*_PLACE, ("ids", pa.large_binary())])
    sql = f"{_PLACE_SQL}, ids binary"

    def __call__(self, ids: bytes) -> bytes:
        return ids


class _Crc32:
    schema = pa.schema([*_PLACE, ("ids_crc32", pa.int64())])
    sql = f"{_PLACE_SQL}, ids_crc32 bigint"

    def __call__(self, ids: bytes) -> int:
        return zlib.crc32(ids)


def read_tokens(spark: SparkSession, folder: str, doc_ids: list[int] | None = None) -> DataFrame:
    """The documents of a folder: ``doc_id, part, block, at, n_tokens, ids``.

    ``at`` is the number of ids before the document in its block.  With ``doc_ids`` only
    the frames of those documents are decompressed.
    """
    wanted = set(doc_ids) if doc_ids is not None else None
    found = spark.read.parquet(f"{folder}/blocks")
    if wanted is not None:
        found = found.filter(F.arrays_overlap("doc_ids", F.array(*map(F.lit, wanted)).cast("array<bigint>")))
    return found.mapInArrow(_reader(spark, folder, wanted, _Ids()), _Ids.sql)


def starts(spark: SparkSession, folder: str) -> DataFrame:
    """Ids before each block: ``part, block, before``.  First over blocks of a part, then
    over parts, of which there are as many as the writing job had tasks."""
    sizes = spark.read.parquet(f"{folder}/blocks").select(
        "part", "block", F.aggregate("n_tokens", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n")
    )
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n"))
    order = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("parts_before"))
    within = F.coalesce(
        F.sum("n").over(W.partitionBy("part").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
    )
    return sizes.withColumn("within", within).join(parts, "part").select(
        "part", "block", (F.col("within") + F.col("parts_before")).alias("before")
    )


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """What is read back, per document: ``doc_id, start, n_tokens, ids_crc32``."""
    blocks = spark.read.parquet(f"{folder}/blocks")
    rows = blocks.mapInArrow(_reader(spark, folder, None, _Crc32()), _Crc32.sql)
    return rows.join(starts(spark, folder), ["part", "block"]).select(
        "doc_id", (F.col("at") + F.col("before")).alias("start"), "n_tokens", "ids_crc32"
    )
