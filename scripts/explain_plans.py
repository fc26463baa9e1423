"""Write docs/PLANS.md: the physical operators of a few representative queries.

    python scripts/explain_plans.py [sf_dir]

Each plan is taken after the query ran, so adaptive plans show their final
shape (stage boundaries, broadcast vs sort-merge, coalesced partitions).
"""

from __future__ import annotations

import contextlib
import datetime as dt
import io
import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def formatted(df) -> str:
    df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    tree = buf.getvalue().split("\n\n")[0]
    return tree.split("+- == Initial Plan ==")[0]      # the operators of the final plan, without their details


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from queuelens.operators import cleaning, filters
    from queuelens.plans import mart as M
    from queuelens.plans import queries as Q
    from queuelens.plans.model import materialized_raw, materialized_star
    from queuelens.session import build_session
    from queuelens.sources import fixtures

    spark = build_session("local[8]", shuffle_partitions=16)
    star = materialized_star(spark, sf_dir)
    raw = materialized_raw(spark, sf_dir)
    f = filters.TicketFilter(start=dt.date(1997, 3, 1), end=dt.date(1997, 4, 30), channels=["1-URGENT"])
    cases = [
        ("q_d2_team: aggregate on the FK, join the aggregate, roll up", Q.q_d2_team(star)),
        ("t_kpis: pushed predicates, pruned months, no agent dimension",
         filters.t_kpis(filters.t_filter(filters.t_panel(star), f))),
        ("cl_pipeline: partial WindowGroupLimit before the dedup shuffle", cleaning.clean_pipeline(raw, fixtures.AS_OF)),
        ("mart_d2_team: from the agent mart", M.mart_d2_team(M.build_agent_mart(star.fact), star)),
    ]
    out = ["# Physical plans", "",
           f"Generated by `scripts/explain_plans.py` over `{sf_dir}` on local[8] "
           "(final adaptive plans). At this size Catalyst broadcasts more than it would at scale; "
           "the shapes that matter -- partial aggregation before each exchange, pushed filters, "
           "pruned columns and partitions, where exchanges sit -- are the same.", ""]
    for title, df in cases:
        out += [f"## {title}", "", "```", formatted(df).strip(), "```", ""]
    with open(os.path.join(ROOT, "docs", "PLANS.md"), "w") as fh:
        fh.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
