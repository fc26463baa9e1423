"""Star joins (j_*): plain inner equi-joins.

Nothing is run at plan-build time: Spark's byte statistics decide on a
broadcast under the session's threshold, and AQE re-plans from real sizes.  A
dimension that grows with the data (agents) is never forced into memory; past
the threshold its join sets the few hot members apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from queuelens.schemas import ENRICHED_COLUMNS


def join_dim(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Inner equi-join of ``fact`` to ``dim`` on ``key`` (fact rows without a
    matching member are dropped, as with SQL ``JOIN``)."""
    return fact.join(dim, key, "inner")


# A member with this share of the fact or more is hot; there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 0.005


def fits_broadcast(dim: DataFrame) -> bool:
    """Whether Spark's own size estimate of ``dim`` is under the session's broadcast threshold (no job is run)."""
    spark = dim.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return limit > 0 and dim._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def split_join(fact: DataFrame, dim: DataFrame, key: str, hot_share: float = HOT_SHARE) -> DataFrame:
    """The inner join of :func:`join_dim` for a dimension too large to broadcast, whatever the share of one member.

    One aggregate over the key alone finds the hot members.  Their rows, at
    most ``1 / hot_share`` of the dimension, are attached to the fact where it
    lies; all other fact rows are joined by a shuffle in which no key has
    ``hot_share`` of the rows.
    """
    counts = fact.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    most = counts.orderBy(F.desc("_n"), key).limit(int(1 / hot_share))   # the only members that can be hot
    total = counts.agg(F.sum("_n")).scalar()
    hot = F.broadcast(most.where(F.col("_n") >= F.lit(hot_share) * total).select(key))
    frequent = fact.join(F.broadcast(dim.join(hot, key, "left_semi")), key, "inner")
    rest = fact.join(hot, key, "left_anti").join(dim.hint("merge"), key, "inner")
    return frequent.unionByName(rest)


def join_category(fact: DataFrame, dim_category: DataFrame) -> DataFrame:
    """j_category: adds name, group and the dimension's own target
    (``category_sla_target_hours``) next to the fact's copy."""
    dim = dim_category.select("category_id", "category_name", "category_group",
                              F.col("sla_target_hours").alias("category_sla_target_hours"))
    return join_dim(fact, dim, "category_id")


def join_channel(fact: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """j_channel."""
    return join_dim(fact, dim_channel, "channel_id")


def join_agent(fact: DataFrame, dim_agent: DataFrame) -> DataFrame:
    """j_agent: the -1 'Unassigned' member keeps unassigned tickets.

    That member holds a fixed share of all tickets: where the agents outgrow a
    broadcast, it is attached apart (:func:`split_join`)."""
    return (join_dim if fits_broadcast(dim_agent) else split_join)(fact, dim_agent, "agent_id")


def enriched(fact: DataFrame, dim_category: DataFrame, dim_channel: DataFrame,
             dim_agent: DataFrame) -> DataFrame:
    """j_enriched: the 16-column detail model (fact x 3 dimensions).

    The fact's own ``sla_target_hours`` is kept (the detail model reads it
    from the fact); the category's target is not carried.
    """
    cat = dim_category.select("category_id", "category_name", "category_group")
    out = join_dim(fact, cat, "category_id")
    out = join_dim(out, dim_channel.select("channel_id", "channel_name"), "channel_id")
    out = join_agent(out, dim_agent.select("agent_id", "agent_name", "team"))
    return out.select(*ENRICHED_COLUMNS)
