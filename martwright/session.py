"""Session defaults and shuffle sizing."""

from __future__ import annotations

from pyspark.sql import SparkSession

CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.shuffle.partitions": "8",
}

MB = 1024 * 1024

# Below these sizes a task is too short, above these counts the bookkeeping (one block per map and
# reduce task) outgrows the driver; in between, partitions of about 128 MB fit in a task's memory.
PARTITION_BYTES = 128 * MB
MOST_SHUFFLE_PARTITIONS = 50_000
MOST_SCAN_TASKS = 200_000
MOST_SCAN_BYTES = 1024 * MB


def build_session(app: str = "martwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    settings = dict(CLUSTER_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings.update(LOCAL_CONF)
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shuffle_partitions_for(input_bytes: int, cores: int) -> int:
    """About 128 MB of decoded rows per partition, at least one partition per core, at most 50 000.

    Parquet is taken to double when decoded. Adaptive execution merges what turns out too small, so
    erring upwards is cheap, whereas too few partitions spill. Beyond some 3.2 TB of input the cap
    holds and partitions grow instead: 100 TB give 4 GB of decoded rows each. Aggregates and merge
    joins then sort and spill to disk, they do not fail; more memory per task or tables stored in
    ranges of their key (``--partition-facts``) avoid it.
    """
    wanted = -(-2 * input_bytes // PARTITION_BYTES)
    return min(max(wanted, cores, 1), max(MOST_SHUFFLE_PARTITIONS, cores))


def scan_bytes_for(input_bytes: int) -> int:
    """Bytes of input per scan task: 128 MB, more only where that would mean too many tasks."""
    return min(max(PARTITION_BYTES, input_bytes // MOST_SCAN_TASKS), MOST_SCAN_BYTES)


def sized_session(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session beside ``spark``, with its settings, whose scans and shuffles suit ``input_bytes`` of Parquet.

    Tables read in it, and all that is planned on them, keep these sizes, while other tables worked
    on at the same time have theirs.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if own.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    cores = spark.sparkContext.defaultParallelism
    own.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions_for(input_bytes, cores)))
    own.conf.set("spark.sql.files.maxPartitionBytes", str(scan_bytes_for(input_bytes)))
    return own
