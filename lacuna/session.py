"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings.  All of them can be changed on a live session, so the
# library also works on a session it did not build.
RUNTIME_CONF = {
    # A repeated key keeps its last value instead of voiding the record.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # A task that reads one large file writes one: no sort of its rows by file name.
    # Past a few names the sort is cheaper than that many open column writers.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
    # file_name stays text even when every name looks like a number.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # The JVM never compiles methods beyond 8000 bytes of bytecode: rather than one
    # such loop for a wide projection, have it split into methods that are.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # A compressed line file costs far more to parse than to open.  With the default
    # open cost small files are packed by their number, and since Spark packs the
    # largest first, one task would get all the large ones.
    "spark.sql.files.openCostInBytes": str(64 << 10),
    # Lines may be long; batches handed to Python stay small in rows.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}

TASKS_PER_CORE = 3

# Without these two a record with a repeated key would be read as no record at all.
REQUIRED = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def require(spark: SparkSession) -> None:
    """Raise if the session would drop records that repeat a key."""
    wrong = [k for k, v in REQUIRED.items() if spark.conf.get(k, "").lower() != v.lower()]
    if wrong:
        raise RuntimeError(f"call lacuna.session.prepare(spark): {', '.join(wrong)} not set")


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    # A few scan tasks per core, so that unequal ones even out.
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.files.minPartitionNum", str(tasks))
    return spark


def local_session(cores: int | str = "*", app_name: str = "lacuna", **conf: str) -> SparkSession:
    """A local session for tests and benches (a cluster brings its own)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
