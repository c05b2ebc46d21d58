"""Replaying a landed feed through the stateful operator.

The feed goes through in slices of a fixed number of offsets per group, one
micro-batch each, from one checkpoint.  However large a group is, a task holds at
most one slice of it, and a lost task starts again from the state before its slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedarb.params import ArbitrationParams
from feedarb.plans.storage import new_path
from feedarb.sources.landing import GROUP
from feedarb.streaming.processor import (
    MESSAGE_SCHEMA,
    STATEFUL_SETTINGS,
    arbitrate,
    tag_confirmations,
    tag_copies,
)

SLICE_OFFSETS = 1_000_000


def place_confirmations(copies: DataFrame, confirmed: DataFrame) -> DataFrame:
    """Add ``seq_offset``: the first copy at or after the confirmation.

    There are as many confirmations as removed machines; copies are combined per
    span between two of them.  A confirmation after the last copy is left out.
    """
    times = confirmed.groupBy(*GROUP).agg(
        F.array_sort(F.collect_set("terminated_us")).alias("_times")
    )
    firsts = (
        copies.select(*GROUP, "arr_us", "seq_offset")
        .join(times, [*GROUP])
        .withColumn(
            "_after", F.array_max(F.filter("_times", lambda t: t <= F.col("arr_us")))
        )
        .where(F.col("_after").isNotNull())
        .groupBy(*GROUP, "_after", "_times")
        .agg(F.min("seq_offset").alias("_first"))
        # A span without copies of its own takes the next copy: serve every earlier time.
        .groupBy(*GROUP, "_times")
        .agg(F.array_sort(F.collect_list(F.struct("_after", "_first"))).alias("_spans"))
    )
    later = F.filter("_spans", lambda s: s["_after"] >= F.col("terminated_us"))
    return (
        confirmed.join(firsts, [*GROUP])
        .withColumn("seq_offset", F.get(later, F.lit(0))["_first"])
        .where(F.col("seq_offset").isNotNull())
        .drop("_times", "_spans")
    )


def replay(
    copies: DataFrame,
    params: ArbitrationParams,
    confirmed: DataFrame | None = None,
    slice_offsets: int = SLICE_OFFSETS,
) -> DataFrame:
    """Everything the live operator would have emitted for a landed feed."""
    # A session of its own: the state store setting must not reach the caller's.
    session = copies.sparkSession.newSession()
    for name, value in STATEFUL_SETTINGS.items():
        session.conf.set(name, value)
    # A state partition costs a store and a worker, empty or not: no more of them
    # than the cluster can run at once.
    slots = 2 * session.sparkContext.defaultParallelism
    wanted = int(copies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    session.conf.set("spark.sql.shuffle.partitions", str(min(wanted, slots)))
    session.conf.set(
        "spark.sql.session.timeZone", copies.sparkSession.conf.get("spark.sql.session.timeZone")
    )

    tagged = tag_copies(copies)
    if confirmed is not None:
        tagged = tagged.unionByName(tag_confirmations(place_confirmations(copies, confirmed)))
    # Copies alone tell how far the feed goes; a range on the offset reaches the scan.
    last = copies.agg(F.max("seq_offset")).first()[0]
    starts = [] if last is None else range(0, last + 1, slice_offsets)

    inbox, results, checkpoint = (
        new_path(session, label) for label in ("inbox", "replayed", "replay-checkpoint")
    )
    schema = tagged.schema
    for start in starts:
        offset = F.col("seq_offset")
        part = tagged.where((offset >= start) & (offset < start + slice_offsets))
        part.write.mode("append").parquet(inbox)
        feed = session.readStream.schema(schema).parquet(inbox)
        query = (
            arbitrate(feed, params)
            .writeStream.format("parquet")
            .option("path", results)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return copies.sparkSession.read.schema(MESSAGE_SCHEMA).parquet(results)


def uncertain_groups(copies: DataFrame, certificate: DataFrame) -> DataFrame:
    """Copies of the groups whose closed form is not the whole story."""
    return copies.join(certificate.where("readmitted_keys > 0"), [*GROUP], "left_semi")


def state_snapshot(messages: DataFrame) -> DataFrame:
    """Where every group stands: gate, cache, window, wins in the window so far."""
    latest = F.struct(
        "gate_open",
        "pending",
        "window_start_us",
        F.size("ignored_sources").alias("ignored_sources"),
        "counts",
    )
    return (
        messages.where(F.col("kind") == "state")
        .groupBy(*GROUP)
        .agg(
            F.sum("consumed").alias("consumed"),
            F.sum("forwarded").alias("forwarded"),
            F.sum("duplicates").alias("duplicates"),
            F.sum("ignored").alias("ignored"),
            # Time alone can tie between micro-batches; state rows keep their order in it.
            F.max_by(latest, F.struct("at_us", "state_no")).alias("_latest"),
        )
        .select(*GROUP, "consumed", "forwarded", "duplicates", "ignored", "_latest.*")
    )
