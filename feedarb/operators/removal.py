"""Which verdicts to act on, on which machine, and what became of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedarb import texts
from feedarb.functions.identity import node_identity
from feedarb.params import RemovalParams
from feedarb.plans.ordered import BLOCK_WIDTH, next_marked
from feedarb.sources.landing import GROUP

# Names under which message types are reported.
TYPE_NAMES = {
    "tally": "Tally",
    "verdict": "VerdictMessage",
    "gate_stalled": "GateStalled",
    "kill_confirmed": "KillConfirmed",
}


def handled_sources(outcomes: DataFrame) -> DataFrame:
    """First verdict offset at which each (group, source) was removed successfully."""
    return (
        outcomes.where("ok")
        .groupBy(*GROUP, "source_id")
        .agg(F.min("verdict_offset").alias("handled_offset"))
    )


def verdict_actions(decoded: DataFrame, handled: DataFrame) -> DataFrame:
    """Add ``act`` and ``action_reason`` to every decoded log message.

    A message repeats an action when its source was removed at an earlier offset;
    the removing verdict itself still acts.  Malformed messages never get here.
    """
    kind = F.col("message_type")
    name = F.col("slowest_source_id")
    repeated = F.coalesce(F.col("handled_offset") < F.col("offset"), F.lit(False))
    type_name = F.lit(None).cast("string")
    for wire, shown in TYPE_NAMES.items():
        type_name = F.when(kind == wire, F.lit(shown)).otherwise(type_name)
    reason = (
        F.when(F.col("decode_status") == "unrecognised", F.lit(texts.UNRECOGNISED))
        .when(kind != "verdict", F.format_string(texts.NOT_A_VERDICT, type_name))
        .when(
            name.isNull(),
            F.format_string(
                texts.NO_CONCLUSION,
                F.coalesce(F.nullif("reason", F.lit("")), F.lit(texts.NO_REASON)),
            ),
        )
        .when(repeated, F.format_string(texts.ALREADY_ACTED, name, "stream_type", "symbol"))
        .otherwise(F.format_string(texts.SLOWEST, name, "total_events", "sources_seen"))
    )
    # Most of the log names no source.  A text of its own, which no machine has as
    # its name, keeps a shuffle from sending all those rows to the one of nulls.
    nobody = F.concat(F.lit("\n"), "partition", F.lit("/"), "offset")
    keyed = handled.withColumnRenamed("source_id", "_named")
    return (
        decoded.where(F.col("decode_status") != "malformed")
        .withColumn("_named", F.coalesce(name, nobody))
        .join(keyed, [*GROUP, "_named"], "left")
        .withColumn(
            "act",
            F.coalesce((kind == "verdict") & name.isNotNull() & ~repeated, F.lit(False)),
        )
        .withColumn("action_reason", reason)
        .drop("handled_offset", "_named")
    )


def eligibility(params: RemovalParams) -> Column:
    """Why a joined node may not be removed; null if it may.

    Needs ``node_name`` (null when the inventory has no such node) and ``labels``.
    """
    label, value = params.required_label, params.required_value
    actual = F.try_element_at("labels", F.lit(label))
    return (
        F.when(F.col("node_name").isNull(), F.lit(texts.NODE_NOT_FOUND))
        .when(actual.isNull(), F.lit(texts.LABEL_MISSING % (label, label, value)))
        .when(
            actual != value,
            F.format_string(texts.LABEL_DIFFERS, F.lit(label), actual, F.lit(value)),
        )
    )


def running_by_address(instances: DataFrame) -> DataFrame:
    """Running machines per private address: how many, and which if just one."""
    return (
        instances.where(F.col("state") == "running")
        .groupBy("private_ip")
        .agg(F.count("*").alias("running"), F.min("instance_id").alias("running_id"))
    )


def inventory(nodes: DataFrame, instances: DataFrame, params: RemovalParams) -> DataFrame:
    """What removing each node would meet: label check, identity, machine lookup.

    Decided once per node, not once per verdict.
    """
    looked_up = F.col("private_ip").isNotNull()
    return (
        nodes.withColumnRenamed("name", "node_name")
        .withColumn("_identity", node_identity(F.col("provider_id"), F.col("node_name")))
        .select("node_name", "labels", "_identity.*")
        .join(running_by_address(instances), "private_ip", "left")
        .select(
            "node_name",
            "private_ip",
            eligibility(params).alias("label_problem"),
            F.coalesce(
                F.col("instance_id"), F.when(F.col("running") == 1, F.col("running_id"))
            ).alias("instance_id"),
            F.when(F.col("instance_id").isNotNull(), "provider_id")
            .when(~looked_up, "unidentifiable")
            .when(F.col("running").isNull(), "not_found")
            .when(F.col("running") > 1, "ambiguous")
            .otherwise("address")
            .alias("identified_by"),
        )
    )


def removal_plan(
    actions: DataFrame, nodes: DataFrame, instances: DataFrame, params: RemovalParams
) -> DataFrame:
    """What to do about every verdict that calls for action.

    A dry run is decided before any node is looked at.  Verdicts on one source may
    be many: the node side carries one row per node, so a skewed join can be split.
    """
    named = actions.where("act").select(
        "partition",
        "offset",
        *GROUP,
        F.col("slowest_source_id").alias("source_id"),
        "window_end",
        "correlation_id",
    )
    ready = inventory(nodes, instances, params).withColumnRenamed("node_name", "source_id")
    planned = named.join(ready.withColumn("_known", F.lit(True)), "source_id", "left")
    unidentified = F.col("identified_by") == "unidentifiable"
    action = (
        F.when(F.lit(params.dry_run), "dry_run")
        .when(F.col("_known").isNull(), "refused:node_not_found")
        .when(F.col("label_problem").isNotNull(), "refused:ineligible_label")
        .when(F.lit(params.armed) & unidentified, "refused:unidentifiable_instance")
        .otherwise("terminate" if params.armed else "cordon_drain")
    )
    return planned.withColumn("planned_action", action).drop("_known")


def attempted(plan: DataFrame) -> DataFrame:
    return plan.where(F.col("planned_action").isin("terminate", "cordon_drain"))


def with_outcomes(plan: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Attempts joined to what was recorded about them; both sides are one per verdict.

    Without exactly one running machine there is nothing to terminate: an attempt that
    got as far as that ends there as failed, whatever was recorded.
    """
    recorded = outcomes.select(
        *GROUP,
        "source_id",
        F.col("verdict_offset").alias("offset"),
        F.col("stage").alias("_stage"),
        F.col("ok").alias("_ok"),
        F.col("terminated_us").alias("_terminated_us"),
    )
    stopped = (
        (F.col("planned_action") == "terminate")
        & ~resolved()
        & F.coalesce("_ok", F.lit(False))
    )
    return (
        attempted(plan)
        .join(recorded, [*GROUP, "source_id", "offset"], "left")
        .withColumns(
            {
                "stage": F.when(stopped, F.lit("terminate")).otherwise(F.col("_stage")),
                "ok": F.col("_ok") & ~stopped,
                "terminated_us": F.when(~stopped, F.col("_terminated_us")),
            }
        )
        .drop("_stage", "_ok", "_terminated_us")
    )


def resolved() -> Column:
    """Is exactly one machine known for the node?"""
    return F.coalesce(F.col("identified_by").isin("provider_id", "address"), F.lit(False))


def confirmations(settled: DataFrame) -> DataFrame:
    """Confirmation messages: only for terminations that were armed and succeeded."""
    done = (F.col("planned_action") == "terminate") & F.coalesce("ok", F.lit(False))
    return settled.where(done).select(
        *GROUP,
        "source_id",
        "instance_id",
        "terminated_us",
        "correlation_id",
    )


def match_confirmations(decoded: DataFrame, width: int = BLOCK_WIDTH) -> DataFrame:
    """Each naming verdict with the first later confirmation of its source, if any.

    Verdicts and confirmations of a source are read as one ordered run, so nothing
    is paired with everything even if one source has most of the log.
    """
    confirming = F.col("message_type") == "kill_confirmed"
    run = decoded.where(confirming | F.coalesce("is_actionable", F.lit(False))).select(
        *GROUP,
        F.coalesce("slowest_source_id", "source_id").alias("source_id"),
        "partition",
        "offset",
        "window_end",
        "terminated_at",
        confirming.alias("_confirming"),
    )
    found = next_marked(
        run,
        [*GROUP, "source_id"],
        "offset",
        F.col("_confirming"),
        ["terminated_at"],
        "_next",
        width,
    )
    return found.where(~F.col("_confirming")).select(
        *GROUP,
        "source_id",
        "partition",
        "offset",
        "window_end",
        F.col("_next.offset").alias("confirmed_offset"),
        F.col("_next.terminated_at").alias("confirmed_at"),
    )


def reconcile(matched: DataFrame, plan: DataFrame) -> DataFrame:
    """Per group: verdicts named, refused, confirmed and outstanding.

    A refusal never closes the loop, so a refused verdict is not outstanding.
    """
    refused = plan.where(F.col("planned_action").startswith("refused:")).select(
        "partition", "offset", F.lit(True).alias("_refused")
    )
    is_refused = F.coalesce("_refused", F.lit(False))
    is_confirmed = F.col("confirmed_offset").isNotNull()
    return (
        matched.join(refused, ["partition", "offset"], "left")
        .groupBy(*GROUP)
        .agg(
            F.count("*").alias("named"),
            F.count_if(is_refused).alias("refused"),
            F.count_if(is_confirmed & ~is_refused).alias("confirmed"),
            F.count_if(~is_confirmed & ~is_refused).alias("outstanding"),
        )
    )
