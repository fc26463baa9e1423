"""Physical-plan shape: the properties the design relies on at scale."""

from __future__ import annotations

import pytest

from queuelens.operators import cleaning, filters
from queuelens.plans import queries as Q
from queuelens.plans.model import materialized_star
from queuelens.sources import fixtures
from tests.conftest import SF_SMALL, explain_text


def plan_of(df) -> str:
    df.collect()  # so the adaptive plan shown is the final one
    return explain_text(df)


@pytest.fixture(scope="module")
def star(spark):
    return materialized_star(spark, SF_SMALL)


@pytest.mark.parametrize("key", sorted(Q.QUERIES))
def test_no_python_in_catalog_plans(star, key):
    p = plan_of(Q.QUERIES[key](star))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


@pytest.mark.parametrize("key", ["q_b1_category", "q_d1_channel", "q_d2_team", "q_b5_value_at_risk"])
def test_fact_is_aggregated_before_the_dimension_join(star, key):
    p = plan_of(Q.QUERIES[key](star))
    # a partial aggregate sits right above the fact scan, below every exchange
    assert "HashAggregate" in p and "partial_" in p
    assert "SortMergeJoin" not in p or "BroadcastHashJoin" in p


def test_fact_scan_is_pruned_to_needed_columns(star):
    p = plan_of(Q.q_d4_unassigned(star))
    assert "ReadSchema: struct<agent_id:int>" in p or "struct<agent_id:int>" in p


def test_filter_pushes_to_parquet_and_prunes_months(star):
    import datetime as dt
    e = filters.t_load(star)
    f = filters.t_filter(e, filters.TicketFilter(start=dt.date(1997, 3, 1), end=dt.date(1997, 4, 30),
                                                 channels=["1-URGENT"]))
    p = plan_of(f)
    assert "PartitionFilters" in p and "opened_month" in p
    assert "PushedFilters" in p


def test_dedup_limits_groups_before_the_shuffle(spark):
    raw = fixtures.raw_fact(spark, SF_SMALL)
    p = explain_text(cleaning.dedup_first(cleaning.type_raw(raw)))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_median_never_sorts_rows_globally(star):
    p = plan_of(Q.q_a2_mean_median(star))
    # the only global-ordering windows run over histograms; no range
    # partitioning / global sort of the fact appears
    assert "rangepartitioning" not in p.lower()
