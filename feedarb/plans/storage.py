"""Tables written to the shared checkpoint folder.

A written table cuts lineage: it is read back by every later stage and still
there after executors are lost.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Shuffled bytes that a task takes.  Rows of a feed are shuffled in some 15 bytes each, compressed,
#: and take several hundred in a hash table or a sort.
TASK_SIZE = 4 << 20
TASK_BYTES = f"{TASK_SIZE >> 20}m"
#: Bytes of a table's files that a task reads, and of a row group in tables written here: a
#: landed copy takes some 25 of them, and several hundred in a sort.
READ_BYTES = 8 << 20

#: Bytes shuffled at once per byte of the events' file: five copies of each event, a bit over one of its rows each.
SHUFFLE_GROWTH = 8
_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"

_local_roots: dict[str, str] = {}
#: Partitions that this module gave to an application's session.
_given: dict[str, str] = {}


def bounded_tasks(spark: SparkSession) -> None:
    """Tasks of ``TASK_BYTES`` after a shuffle and ``READ_BYTES`` of files, unless the session has sizes of its own."""
    for key, usual, size in (
        ("spark.sql.adaptive.advisoryPartitionSizeInBytes", 64 << 20, TASK_BYTES),
        ("spark.sql.files.maxPartitionBytes", 128 << 20, str(READ_BYTES)),
    ):
        # As it is if nobody sets it.
        if spark.conf.get(key).lower() in (str(usual), f"{usual}b", f"{usual >> 20}mb"):
            spark.conf.set(key, size)


def enough_partitions(spark: SparkSession, input_bytes: int) -> None:
    """Shuffles of a feed begin with as many partitions as keep tasks at ``TASK_BYTES``, unless the session has a number.

    Adaptive execution joins small partitions but does not cut large ones: with a fixed number, tasks
    grow with the feed until they spill.
    """
    app = spark.sparkContext.applicationId
    own, given = spark.conf.get(_PARTITIONS, None), _given.pop(app, None)
    if own is not None and own != given:
        return
    wanted = -(-input_bytes * SHUFFLE_GROWTH // TASK_SIZE)
    if wanted > int(spark.conf.get("spark.sql.shuffle.partitions")):
        _given[app] = str(wanted)
        spark.conf.set(_PARTITIONS, wanted)
    elif own is not None:
        spark.conf.unset(_PARTITIONS)


def shared_root(spark: SparkSession) -> str:
    """Folder for this application's tables, below ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a folder of its own.
    """
    app = spark.sparkContext.applicationId
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/feedarb/{app}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="feedarb-")
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    For a result read more than once (a numbering pass and the rows it numbers):
    without it each reader would repeat the shuffles below.  Also for a small
    result of a large input: a table's size is known before joins are planned.
    """
    return read_table(df.sparkSession, write_table(df, label))


def write_table(df: DataFrame, label: str) -> str:
    path = new_path(df.sparkSession, label)
    df.write.option("parquet.block.size", READ_BYTES).parquet(path)
    return path


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
