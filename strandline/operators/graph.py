"""Stages as a graph: what a failed check blocks, and what it doesn't.

A line of stages blocks everything behind a failure. Here each feed has its own way through the stages, and a stage is blocked only
if one that it needs, directly or through others, has failed for the same feed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.health import BLOCKED, FAIL, OK
from strandline.operators.lists import listed

# The stages of the reference flow, each with those it reads from.
FLOW = {"producers": (), "kafka": ("producers",), "bronze": ("kafka",), "silver": ("bronze",)}


def in_order(needs: Mapping[str, Sequence[str]]) -> list[str]:
    """All stages, each behind those it needs. A cycle raises, and names its stages."""
    try:
        return list(TopologicalSorter(needs).static_order())
    except CycleError as error:
        raise ValueError(f"stages need each other: {' -> '.join(error.args[1])}") from error


def all_needs(checks: DataFrame, needs: Mapping[str, Sequence[str]]) -> DataFrame:
    """``stage`` and ``needed``, every stage that it needs directly or through others, by a recursive query."""
    in_order(needs)
    spark = checks.sparkSession
    edges = listed(spark, "stage STRING, needed STRING", [(s, n) for s, of in needs.items() for n in of])
    return spark.sql(
        """
        WITH RECURSIVE reach(stage, needed) AS (
            SELECT stage, needed FROM {edges}
            UNION ALL
            SELECT reach.stage, edges.needed FROM reach JOIN {edges} AS edges ON reach.needed = edges.stage
        )
        SELECT DISTINCT stage, needed FROM reach
        """,
        edges=edges,
    )


def stage_graph(
    checks: DataFrame, feeds: Sequence[str], needs: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """One row for each feed and stage: ``feed``, ``stage``, ``status``, ``n_failed``, ``blocked_by``.

    ``checks`` are result rows whose ``check`` names the feed. A stage without rows for a feed has failed for it. ``status`` is FAIL only
    where nothing that the stage needs has failed, else BLOCKED, and ``blocked_by`` names the failed stages it needs, by name.
    ``needs`` says for each stage which ones it reads from; a cycle raises.
    """
    spark = checks.sparkSession
    flow = FLOW if needs is None else needs
    nodes = listed(spark, "feed STRING, stage STRING", [(f, s) for f in feeds for s in in_order(flow)])
    failed = ~F.coalesce("ok", F.lit(False))
    per_node = checks.groupBy(F.col("check").alias("feed"), "stage").agg(
        F.bool_and(~failed).alias("ok"), F.count_if(failed).alias("n_failed")
    )
    state = nodes.join(per_node, ["feed", "stage"], "left").select(
        "feed", "stage", F.coalesce("ok", F.lit(False)).alias("ok"), F.coalesce("n_failed", F.lit(0)).alias("n_failed")
    )
    # The failed ones among what a stage needs; as many rows as there are stages and feeds.
    broken = state.where("NOT ok").select("feed", F.col("stage").alias("needed"))
    blocked = all_needs(checks, flow).join(broken, "needed").groupBy("feed", "stage")
    blocked = blocked.agg(F.concat_ws(",", F.array_sort(F.collect_set("needed"))).alias("blocked_by"))
    status = F.when(F.col("blocked_by").isNotNull(), BLOCKED).when(F.col("ok"), OK).otherwise(FAIL)
    return state.join(blocked, ["feed", "stage"], "left").select(
        "feed", "stage", status.alias("status"), "n_failed", "blocked_by"
    )
