"""DuckDB oracle SQL for the correctness gate.

``STAR_CTE`` rebuilds, in plain SQL over the driver's tables, the same ticket
projection and dimensions as :mod:`queuelens.sources.fixtures`; each oracle
is ``STAR_CTE`` + one SELECT written the way the reference phrases the
question (with the same column aliases as the Spark plan).  Type notes:
DuckDB ``SUM(int)`` is HUGEINT, so sums are cast to BIGINT; ratios are
computed in DOUBLE; money and hour means come from exact DECIMAL sums.
"""

from __future__ import annotations

STAR_CTE = """
WITH li AS (
  SELECT *, l_orderkey * 10 + l_linenumber AS ticket_id,
         row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
                            ORDER BY l_shipdate, l_partkey, l_suppkey, l_extendedprice,
                                     l_quantity, l_discount, l_tax) AS ingest_seq
  FROM lineitem
),
base AS (
  SELECT li.ticket_id, li.ingest_seq, li.l_suppkey,
         printf('CUST%06d', o.o_custkey) AS customer_id,
         CAST(c.c_nationkey AS INTEGER) AS category_id,
         CAST(split_part(o.o_orderpriority, '-', 1) AS INTEGER) AS channel_id,
         CAST(CASE WHEN li.ticket_id % 67 = 0 THEN -1 ELSE li.l_suppkey END AS INTEGER) AS agent_id,
         li.l_extendedprice AS transaction_amount_inr,
         o.o_orderdate + to_seconds((li.l_partkey % 1440) * 60 + li.l_suppkey % 60) AS opened_at,
         (li.l_partkey * 7919 + li.l_suppkey * 104729 + li.l_linenumber * 1299709) % 700000 AS res_secs,
         CASE WHEN li.l_linestatus = 'O' AND o.o_orderdate >= TIMESTAMP '2001-07-02 00:00:00'
              THEN 'Open' ELSE 'Closed' END AS status,
         CAST([24, 48, 72, 96, 120, 168][c.c_nationkey % 6 + 1] AS INTEGER) AS sla_target_hours,
         li.l_returnflag || '-' || CAST(li.l_linenumber AS VARCHAR) AS rc,
         CASE WHEN CAST(o.o_orderdate AS DATE) IN (DATE '1996-10-14', DATE '1999-01-05', DATE '2001-05-22')
              THEN 1 ELSE 0 END AS is_incident_day
  FROM li JOIN orders o ON li.l_orderkey = o.o_orderkey
          JOIN customer c ON o.o_custkey = c.c_custkey
),
proj AS (
  SELECT *,
         CASE WHEN status = 'Closed' THEN opened_at + to_seconds(res_secs) END AS closed_at,
         CASE WHEN status = 'Closed' THEN round_even(res_secs / 3600.0::DOUBLE * 100, 0) / 100 END
           AS resolution_hours
  FROM base
),
all_copies AS (
  SELECT *,
         CAST(CASE WHEN status = 'Closed' THEN coalesce(resolution_hours > sla_target_hours, false)
                   ELSE coalesce(date_diff('second', opened_at, TIMESTAMP '2001-08-01 23:59:59')
                                 / 3600.0::DOUBLE > sla_target_hours, false) END AS INTEGER) AS sla_breached,
         CASE WHEN status = 'Closed' THEN rc END AS root_cause
  FROM proj
),
fact_complaints AS (
  SELECT ticket_id, customer_id, category_id, channel_id, agent_id, transaction_amount_inr,
         opened_at, closed_at, status, resolution_hours, sla_target_hours, sla_breached,
         root_cause, is_incident_day
  FROM all_copies WHERE ingest_seq = 1
),
raw_complaints AS (
  SELECT ingest_seq,
         CAST(ticket_id AS VARCHAR) AS ticket_id,
         CASE WHEN ticket_id % 100 = 7 THEN '  ' || lower(customer_id) || ' ' ELSE customer_id END
           AS customer_id,
         CAST(category_id AS VARCHAR) AS category_id,
         CAST(channel_id AS VARCHAR) AS channel_id,
         CASE WHEN agent_id = -1 THEN NULL ELSE CAST(CAST(agent_id AS DOUBLE) AS VARCHAR) END AS agent_id,
         CAST(transaction_amount_inr AS VARCHAR) AS transaction_amount_inr,
         CASE (ticket_id + ingest_seq) % 4
              WHEN 0 THEN strftime(opened_at, '%Y-%m-%d %H:%M:%S')
              WHEN 1 THEN strftime(opened_at, '%d/%m/%Y %H:%M')
              WHEN 2 THEN strftime(opened_at, '%m-%d-%Y %I:%M %p')
              ELSE strftime(opened_at, '%d-%b-%Y %H:%M:%S') END AS opened_at,
         CASE (ticket_id + l_suppkey) % 4
              WHEN 0 THEN strftime(closed_at, '%Y-%m-%d %H:%M:%S')
              WHEN 1 THEN strftime(closed_at, '%d/%m/%Y %H:%M')
              WHEN 2 THEN strftime(closed_at, '%m-%d-%Y %I:%M %p')
              ELSE strftime(closed_at, '%d-%b-%Y %H:%M:%S') END AS closed_at,
         status,
         CAST(resolution_hours AS VARCHAR) AS resolution_hours,
         CAST(sla_target_hours AS VARCHAR) AS sla_target_hours,
         CAST(sla_breached AS VARCHAR) AS sla_breached,
         root_cause,
         CAST(is_incident_day AS VARCHAR) AS is_incident_day
  FROM all_copies
),
dim_category AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS category_id, n.n_name AS category_name,
         r.r_name AS category_group,
         CAST([24, 48, 72, 96, 120, 168][n.n_nationkey % 6 + 1] AS INTEGER) AS sla_target_hours
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
),
dim_channel AS (
  SELECT DISTINCT CAST(split_part(o_orderpriority, '-', 1) AS INTEGER) AS channel_id,
         o_orderpriority AS channel_name
  FROM orders
),
dim_agent AS (
  SELECT CAST(s_suppkey AS INTEGER) AS agent_id, s_name AS agent_name,
         'Team ' || CAST(s_suppkey % 3 AS VARCHAR) AS team
  FROM supplier
  UNION ALL SELECT -1, 'Unassigned', 'Unassigned'
),
tickets_enriched AS (
  SELECT f.ticket_id, f.customer_id, c.category_name, c.category_group, ch.channel_name,
         a.agent_name, a.team, f.transaction_amount_inr, f.opened_at, f.closed_at, f.status,
         f.resolution_hours, f.sla_target_hours, f.sla_breached, f.root_cause, f.is_incident_day
  FROM fact_complaints f
  JOIN dim_category c ON f.category_id = c.category_id
  JOIN dim_channel ch ON f.channel_id = ch.channel_id
  JOIN dim_agent a ON f.agent_id = a.agent_id
),
tickets_named AS (
  SELECT * FROM fact_complaints LEFT JOIN dim_channel USING (channel_id) LEFT JOIN dim_agent USING (agent_id)
  LEFT JOIN (SELECT category_id, category_name, category_group, sla_target_hours AS category_target FROM dim_category)
    USING (category_id)
)
"""

# Shared expression snippets (DuckDB).
BREACH_PCT = "round(100.0::DOUBLE * sum(sla_breached) / count(*), 1)"
COMPLIANCE_PCT = "round(100.0::DOUBLE * count(*) FILTER (WHERE sla_breached = 0) / count(*), 1)"
AVG_HOURS = ("round(sum(resolution_hours::DECIMAL(18,2))::DOUBLE "
             "/ nullif(count(resolution_hours), 0), 1)")

# Fixed parse layouts for DuckDB's try_strptime (same order as Spark's).
PARSE_FORMATS = "['%Y-%m-%d %H:%M:%S', '%d/%m/%Y %H:%M', '%m-%d-%Y %I:%M %p', '%d-%b-%Y %H:%M:%S']"


def strip_ws(col: str) -> str:
    """DuckDB twin of ``text.strip_ws``: surrounding whitespace removed."""
    return f"regexp_replace({col}, '^\\s+|\\s+$', '', 'g')"


def parse_ts(col: str) -> str:
    """DuckDB twin of ``parse_mixed_timestamp``: layouts, then ISO-shaped cast."""
    t = strip_ws(col)
    return (f"coalesce(try_strptime({t}, {PARSE_FORMATS}), "
            f"CASE WHEN regexp_matches({t}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}([ T]|$)') "
            f"THEN try_cast({t} AS TIMESTAMP) END)")


def q(select: str) -> str:
    return STAR_CTE + select


# ------------------------------------------------------------------ questions
#
# Every question is one template: a per-ticket table with all names and labels
# attached, keys, measures, and what is kept.  Labels come from lists that are
# indexed by a number, so no CASE ladder of the plans is repeated here.

# Labels in the order of their number, and bucket bounds in hours.
WEEKDAYS = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
BUCKETS = ["0-24 hrs", "24-48 hrs", "48-72 hrs", "72-168 hrs", "168+ hrs"]
BOUNDS = [24, 48, 72, 168]
PERIODS = ["Rest of month", "Salary-date window"]


def _label(labels: list[str], number: str) -> str:
    return f"[{', '.join(map(repr, labels))}][1 + {number}]"


_BUCKET_NUMBER = " + ".join(f"CAST(coalesce(resolution_hours, 1e9) > {b} AS INTEGER)" for b in BOUNDS)
KEYS = {
    "month": "strftime(opened_at, '%Y-%m')",
    "day_of_week": _label(WEEKDAYS, "dayofweek(opened_at)"),
    "resolution_bucket": _label(BUCKETS, f"({_BUCKET_NUMBER})"),
    "period": _label(PERIODS, "CAST(day(opened_at) NOT BETWEEN 3 AND 24 AS INTEGER)"),
}
_DAYS = "count(DISTINCT date_trunc('day', opened_at))"
_AMOUNT = "sum(CAST(transaction_amount_inr AS DECIMAL(18,2)))::DOUBLE"
N = "count(*)"
OPEN, CLOSED = ("count(*) FILTER (WHERE status = '%s')" % x for x in ("Open", "Closed"))
VALUE = f"round({_AMOUNT}, 2)"
PER_DAY = f"round(count(*)::DOUBLE / {_DAYS}, 1)"


def ask(keys: list[str], measures: dict[str, str], where: str = "true", keep: str = "") -> str:
    """One row per value of ``keys`` over the tickets with their names; ``keep``: order and limit."""
    columns = [k if " AS " in k else f"{KEYS.get(k, k)} AS {k}" for k in keys] + [f"{e} AS {a}" for a, e in measures.items()]
    group = "GROUP BY ALL" if keys else ""
    return f"\nSELECT {', '.join(columns)}\nFROM tickets_named WHERE {where} {group} {keep}"


_SHARE = {"ticket_count": N, "sla_breach_pct": BREACH_PCT}
_FULL = {"ticket_count": N, "avg_resolution_hours": AVG_HOURS, "sla_breach_pct": BREACH_PCT}
_MEDIAN = "list_sort(list(resolution_hours) FILTER (WHERE resolution_hours IS NOT NULL))[count(resolution_hours) // 2 + 1]"

QUERY_SQL = {
    "q_a1_kpis": ask([], {"total_tickets": N, "closed_tickets": CLOSED, "open_tickets": OPEN,
                          "sla_compliance_pct": COMPLIANCE_PCT.replace(", 1)", ", 2)"), "avg_resolution_hours": AVG_HOURS}),
    "q_a2_mean_median": ask([], {"mean_resolution_hours": AVG_HOURS, "median_resolution_hours": _MEDIAN}),
    "q_a3_value": ask([], {"total_disputed_value_inr": VALUE,
                           "avg_transaction_value_inr": f"round({_AMOUNT} / count(transaction_amount_inr), 2)"}),
    "q_b1_category": ask(["category_name", "category_group", "category_target AS sla_target_hours"], _FULL),
    "q_b2_group": ask(["category_group"], _SHARE),
    "q_b3_root_causes": ask(["root_cause"], {"breached_tickets": N}, "sla_breached = 1 AND root_cause IS NOT NULL",
                            "ORDER BY breached_tickets DESC, root_cause LIMIT 10"),
    "q_b4_buckets": ask(["resolution_bucket"], {"ticket_count": N}, "status = 'Closed'"),
    "q_b5_value_at_risk": ask(["category_group"], {"breached_tickets": N, "disputed_value_inr": VALUE}, "sla_breached = 1"),
    "q_c1_monthly": ask(["month"], {"ticket_count": N}),
    "q_c2_monthly_sla": ask(["month"], {"ticket_count": N, "sla_compliance_pct": COMPLIANCE_PCT}),
    "q_c3_weekday": ask(["day_of_week"], {"ticket_count": N}),
    "q_c4_salary_window": ask(["period"], {"ticket_count": N, "avg_tickets_per_day": PER_DAY}),
    "q_d1_channel": ask(["channel_name"], _SHARE),
    "q_d2_team": ask(["team"], _FULL),
    "q_d3_top_agents": ask(["agent_name", "team"], {"tickets_handled": N, "sla_breach_pct": BREACH_PCT}, "agent_id <> -1",
                           "ORDER BY tickets_handled DESC, agent_name, team LIMIT 5"),
    "q_d4_unassigned": ask([], {"unassigned_tickets": N}, "agent_id = -1"),
    "q_e1_incident_volume": ask(["is_incident_day"], {"days_counted": _DAYS, "total_tickets": N, "avg_tickets_per_day": PER_DAY}),
    "q_e2_incident_categories": ask(["category_name"], {"tickets_on_incident_days": N}, "is_incident_day = 1",
                                    "ORDER BY tickets_on_incident_days DESC, category_name LIMIT 5"),
    "q_e3_incident_sla": ask(["is_incident_day"], _SHARE),
}


def oracle_sql() -> dict[str, str]:
    from queuelens.oracle_more import build

    out = {k: q(v) for k, v in QUERY_SQL.items()}
    out.update({k: q(v) for k, v in build().items()})
    return out
