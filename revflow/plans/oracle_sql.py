"""DuckDB oracle SQL for the registered queries.

Each query shapes the CRM feeds from the supplied tables with the same mapping
as ``revflow.sources.crm_feeds`` and then states the operator's semantics
directly in SQL (windows, joins, aggregates), independently of the Spark code.
"""

from __future__ import annotations

AS_OF_SALES = "2001-08-01 00:00:00"
AS_OF_OPS = "2024-01-31 00:00:00"
AS_OF_OPS_LATE = "2024-02-02 00:00:00"


def money(expr: str) -> str:
    return f"CAST(round(sum(CAST({expr} AS DECIMAL(18,6))), 2) AS DOUBLE)"


OP_TYPE = """CASE WHEN upper(coalesce(change_operation, '')) IN ('DELETE', 'D') THEN 'DELETE'
       WHEN upper(coalesce(change_operation, '')) IN ('UPDATE', 'U') THEN 'UPDATE'
       WHEN upper(coalesce(change_operation, '')) IN ('INSERT', 'I') THEN 'INSERT'
       ELSE 'UNKNOWN' END"""


def blank(c: str) -> str:
    return f"({c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"


def ev_ctes(batch: str = "CAST(ts AS DATE)", ingest: str = "CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP)",
            run: str = "'silver-' || strftime(CAST(ts AS DATE), '%Y%m%d')", where: str = "TRUE") -> str:
    """events -> change log -> bronze op types -> valid rows (deletes checked for the key only)."""
    return f"""
ev_changes AS (
  SELECT event_id, user_id, ts AS modifiedon,
    CASE event_type WHEN 'signup' THEN 'I' WHEN 'purchase' THEN 'U' WHEN 'click' THEN 'U'
                    WHEN 'error' THEN 'D' WHEN 'view' THEN 'X' END AS change_operation,
    value AS amount, event_type,
    {batch} AS batch_date, {ingest} AS batch_ingest_ts, {run} AS batch_run_id
  FROM events
),
ev_bronze AS (SELECT *, {OP_TYPE} AS bronze_op_type FROM ev_changes),
ev_valid AS (
  SELECT *, bronze_op_type = 'DELETE' AS is_del FROM ev_bronze
  WHERE ({where}) AND NOT {blank('user_id')}
    AND (bronze_op_type = 'DELETE' OR NOT coalesce(amount < 0, FALSE))
)"""


def state_ctes(prefix: str, src: str = "ev_valid", hard: bool = False) -> str:
    """Silver state after merging each batch of ``src`` in order (M1 or X30)."""
    win = f"""
{prefix}_win AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, batch_date
      ORDER BY modifiedon DESC NULLS LAST, batch_ingest_ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM {src}) WHERE rn = 1
),
{prefix}_last AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_date DESC) AS r
    FROM {prefix}_win) WHERE r = 1
)"""
    if hard:
        return win + f""",
{prefix}_state AS (
  SELECT user_id, event_id, modifiedon, change_operation, amount, event_type, bronze_op_type,
    TRUE AS is_active, CAST(NULL AS TIMESTAMP) AS silver_deleted_ts, modifiedon AS silver_last_event_ts,
    batch_run_id AS silver_last_run_id, batch_ingest_ts AS silver_updated_ts
  FROM {prefix}_last WHERE NOT is_del
)"""
    return win + f""",
{prefix}_up AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_date DESC) AS r
    FROM {prefix}_win WHERE NOT is_del) WHERE r = 1
),
{prefix}_state AS (
  SELECT u.user_id, u.event_id, u.modifiedon, u.change_operation, u.amount, u.event_type, u.bronze_op_type,
    NOT l.is_del AS is_active,
    CASE WHEN l.is_del THEN coalesce(l.modifiedon, l.batch_ingest_ts) END AS silver_deleted_ts,
    CASE WHEN l.is_del THEN l.modifiedon ELSE u.modifiedon END AS silver_last_event_ts,
    CASE WHEN l.is_del THEN l.batch_run_id ELSE u.batch_run_id END AS silver_last_run_id,
    CASE WHEN l.is_del THEN l.batch_ingest_ts ELSE u.batch_ingest_ts END AS silver_updated_ts
  FROM {prefix}_up u JOIN {prefix}_last l ON u.user_id = l.user_id
)"""


SALES_RUN = f"TIMESTAMP '{AS_OF_SALES}'"
OPS_RUN = f"TIMESTAMP '{AS_OF_OPS}'"

GOLD_AUDIT = """TRUE AS is_active, modifiedon AS source_event_ts, '{run}' AS source_run_id,
    {ts} AS gold_source_updated_ts, {ts} AS gold_updated_ts"""

OPP_CTES = f"""
opp_feed AS (
  SELECT o_orderkey AS opportunityid, 'OPP-' || CAST(o_orderkey AS VARCHAR) AS name,
    o_custkey AS ownerid, o_custkey AS customerid, o_orderdate AS createdon,
    CAST(o_orderdate AS DATE) + 60 AS estimatedclosedate, o_totalprice AS estimatedvalue,
    CAST(CASE o_orderpriority WHEN '1-URGENT' THEN 90 WHEN '2-HIGH' THEN 70 WHEN '3-MEDIUM' THEN 50
         WHEN '4-NOT SPECIFIED' THEN 30 WHEN '5-LOW' THEN 10 END AS DOUBLE) AS closeprobability,
    o_orderstatus AS statuscode,
    CASE o_orderstatus WHEN 'O' THEN 'Open' WHEN 'F' THEN 'Won' WHEN 'P' THEN 'Lost' END AS statecode,
    o_orderpriority AS stepname, o_orderdate AS modifiedon
  FROM orders
),
opp_silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY opportunityid ORDER BY modifiedon DESC NULLS LAST) AS rn
    FROM opp_feed
    WHERE NOT {blank('opportunityid')} AND NOT {blank('createdon')} AND NOT coalesce(estimatedvalue < 0, FALSE)
  ) WHERE rn = 1
),
fact_opportunity AS (
  SELECT opportunityid AS opportunity_id, name AS opportunity_name, ownerid AS owner_id, customerid AS account_id,
    createdon AS created_ts, modifiedon AS modified_ts, estimatedclosedate AS expected_close_date,
    estimatedvalue AS estimated_value, closeprobability AS probability, statuscode AS status_code,
    statecode AS state_code, stepname AS stage_name,
    {GOLD_AUDIT.format(run='silver-opportunity', ts=SALES_RUN)},
    estimatedvalue * (closeprobability / 100.0) AS weighted_amount,
    CAST(createdon AS DATE) AS created_date,
    CAST(date_trunc('month', estimatedclosedate) AS TIMESTAMP) AS expected_close_month
  FROM opp_silver
)"""

QUOTE_CTES = f"""
quote_changes AS (
  SELECT l_orderkey * 10 + l_linenumber AS quoteid, l_orderkey AS opportunityid,
    'Q-' || CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS name,
    CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS quotenumber,
    l_extendedprice * (1.0 - l_discount) AS totalamount, l_shipdate AS createdon, l_shipdate AS modifiedon,
    l_returnflag AS statuscode, l_linestatus AS statecode, l_extendedprice, l_partkey, l_suppkey
  FROM lineitem
),
quote_latest AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY quoteid ORDER BY modifiedon DESC NULLS LAST,
      l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
    FROM quote_changes) WHERE rn = 1
),
quote_silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY quoteid ORDER BY modifiedon DESC NULLS LAST,
      l_extendedprice DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
    FROM quote_changes WHERE NOT {blank('quoteid')} AND NOT coalesce(totalamount < 0, FALSE)) WHERE rn = 1
),
fact_quote AS (
  SELECT quoteid AS quote_id, opportunityid AS opportunity_id, name AS quote_name, quotenumber AS quote_number,
    totalamount AS quote_amount, createdon AS created_ts, modifiedon AS modified_ts, statuscode AS status_code,
    statecode AS state_code,
    {GOLD_AUDIT.format(run='silver-quote', ts=SALES_RUN)},
    CAST(createdon AS DATE) AS created_date
  FROM quote_silver
),
contract_feed AS (
  SELECT quoteid AS contractid, opportunityid, quoteid, 'C-' || CAST(quoteid AS VARCHAR) AS title,
    totalamount AS totalprice, createdon AS activeon, createdon + INTERVAL 365 DAY AS expireson,
    createdon, modifiedon, 'Active' AS statuscode, statecode
  FROM quote_latest WHERE statuscode = 'N'
),
fact_contract AS (
  SELECT contractid AS contract_id, opportunityid AS opportunity_id, quoteid AS quote_id, title AS contract_name,
    totalprice AS contract_value, activeon AS start_date, expireson AS end_date, createdon AS created_ts,
    modifiedon AS modified_ts, statuscode AS status_code, statecode AS state_code,
    {GOLD_AUDIT.format(run='silver-contract', ts=SALES_RUN)},
    CAST(createdon AS DATE) AS created_date
  FROM contract_feed WHERE NOT {blank('contractid')} AND NOT coalesce(totalprice < 0, FALSE)
)"""

ACTIVITY_CTES = f"""
fact_activity AS (
  SELECT event_id AS activity_id,
    CASE event_type WHEN 'click' THEN 'phonecall' ELSE 'appointment' END AS activity_type,
    event_id AS opportunity_id, user_id AS owner_id,
    CASE event_type WHEN 'click' THEN 'phonecall ' ELSE 'appointment ' END || CAST(event_id AS VARCHAR) AS subject,
    ts AS scheduled_start, ts + INTERVAL 30 MINUTE AS scheduled_end,
    CASE WHEN event_type = 'click' THEN ts + INTERVAL 30 MINUTE END AS actual_end,
    ts AS created_ts, ts AS modified_ts,
    CASE event_type WHEN 'click' THEN 'Completed' ELSE 'Scheduled' END AS status_code,
    CASE event_type WHEN 'click' THEN 'Closed' ELSE 'Open' END AS state_code,
    TRUE AS is_active, ts AS source_event_ts,
    CASE event_type WHEN 'click' THEN 'silver-phonecall' ELSE 'silver-appointment' END AS source_run_id,
    {OPS_RUN} AS gold_source_updated_ts, {OPS_RUN} AS gold_updated_ts
  FROM events WHERE event_type IN ('click', 'view') AND event_id IS NOT NULL
)"""

OWNER_CTES = """
owners AS (
  SELECT c_custkey AS owner_id, c_name AS owner_name, r_name AS region, c_mktsegment AS department
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""

RUN_CTES = """
runs AS (
  SELECT CAST(event_id AS VARCHAR) AS run_id, CAST(NULL AS VARCHAR) AS parent_run_id,
    'crm_' || (['bronze', 'silver', 'gold', 'gold_snapshot'])[CAST(floor(user_id / 6) % 4 AS BIGINT) + 1] || '_' ||
      (['opportunity', 'quote', 'contract', 'phonecall', 'appointment', 'pipeline_item'])[CAST(user_id % 6 AS BIGINT) + 1]
      AS pipeline_name,
    (['opportunity', 'quote', 'contract', 'phonecall', 'appointment', 'pipeline_item'])[CAST(user_id % 6 AS BIGINT) + 1]
      AS entity_name,
    (['bronze', 'silver', 'gold', 'gold_snapshot'])[CAST(floor(user_id / 6) % 4 AS BIGINT) + 1] AS layer_name,
    'scheduled' AS trigger_type, 1 AS attempt_no, ts AS run_start_ts,
    ts + to_seconds(CAST(floor(value) AS BIGINT)) AS run_end_ts,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'partial_success' WHEN 'signup' THEN 'skipped'
         ELSE 'success' END AS status,
    strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS source_high_watermark,
    CAST(floor(value) AS BIGINT) AS source_row_count,
    CASE WHEN event_type = 'error' THEN 0 ELSE CAST(floor(value) AS BIGINT) END AS target_row_count,
    CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS rows_quarantined,
    CASE WHEN event_type = 'error' THEN 'error in run ' || CAST(event_id AS VARCHAR) END AS error_message,
    ts AS created_ts, ts AS updated_ts
  FROM events
),
watermarks AS (
  SELECT entity_name, layer_name, 'source_high_watermark' AS watermark_type, source_high_watermark AS watermark_value,
    run_id, TRUE AS is_current, updated_ts FROM runs
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n"


ORACLES: dict[str, str] = {}

ORACLES["fact_opportunity"] = with_(OPP_CTES) + "SELECT * FROM fact_opportunity"
ORACLES["fact_quote"] = with_(QUOTE_CTES) + "SELECT * FROM fact_quote"
ORACLES["fact_contract"] = with_(QUOTE_CTES) + "SELECT * FROM fact_contract"
ORACLES["fact_activity"] = with_(ACTIVITY_CTES) + "SELECT * FROM fact_activity"

ORACLES["rep_scorecard"] = with_(OPP_CTES) + f"""
SELECT owner_id, count(*) AS open_opportunity_count, {money('estimated_value')} AS open_pipeline_value,
  {money('weighted_amount')} AS weighted_pipeline_value
FROM fact_opportunity GROUP BY owner_id"""

ORACLES["stale_deals"] = with_(OPP_CTES) + f"""
SELECT opportunity_id, owner_id, modified_ts, state_code, estimated_value FROM fact_opportunity
WHERE modified_ts < TIMESTAMP '{AS_OF_SALES}' - INTERVAL 30 DAY"""

ORACLES["open_deals_by_stage"] = with_(OPP_CTES) + f"""
SELECT stage_name, count(*) AS open_count, {money('estimated_value')} AS pipeline_value,
  {money('weighted_amount')} AS weighted_value
FROM fact_opportunity WHERE state_code = 'Open' GROUP BY stage_name"""

ORACLES["win_rate"] = with_(OPP_CTES) + """
SELECT owner_id, won_count, lost_count,
  CASE WHEN won_count + lost_count > 0 THEN won_count / (won_count + lost_count) END AS win_rate
FROM (SELECT owner_id, count(*) FILTER (WHERE state_code = 'Won') AS won_count,
        count(*) FILTER (WHERE state_code = 'Lost') AS lost_count
      FROM fact_opportunity GROUP BY owner_id)"""

ORACLES["quote_trend"] = with_(QUOTE_CTES) + f"""
SELECT CAST(date_trunc('month', created_ts) AS TIMESTAMP) AS quote_month, count(*) AS quote_count,
  {money('quote_amount')} AS quote_value
FROM fact_quote GROUP BY 1"""

ORACLES["quote_conversion"] = with_(OPP_CTES, QUOTE_CTES) + """
SELECT o.n AS opportunity_count, oq.n AS opportunities_with_quote,
  CASE WHEN o.n > 0 THEN oq.n / o.n END AS opportunity_to_quote_rate,
  q.n AS quote_count, qc.n AS quotes_with_contract,
  CASE WHEN q.n > 0 THEN qc.n / q.n END AS quote_to_contract_rate
FROM (SELECT count(*) AS n FROM fact_opportunity) o,
     (SELECT count(*) AS n FROM fact_opportunity WHERE opportunity_id IN (SELECT opportunity_id FROM fact_quote)) oq,
     (SELECT count(*) AS n FROM fact_quote) q,
     (SELECT count(*) AS n FROM fact_quote WHERE quote_id IN (SELECT quote_id FROM fact_contract)) qc"""

ORACLES["contract_lifecycle"] = with_(QUOTE_CTES) + f"""
SELECT CAST(date_trunc('month', start_date) AS TIMESTAMP) AS start_month,
  CASE WHEN start_date > TIMESTAMP '{AS_OF_SALES}' THEN 'Future'
       WHEN end_date <= TIMESTAMP '{AS_OF_SALES}' THEN 'Expired' ELSE 'Active' END AS lifecycle_status,
  count(*) AS contract_count, {money('contract_value')} AS contract_value
FROM fact_contract GROUP BY 1, 2"""

ORACLES["executive_kpis"] = with_(OPP_CTES) + f"""
SELECT {money("CASE WHEN state_code = 'Open' THEN estimated_value END")} AS pipeline_revenue,
  {money("CASE WHEN state_code = 'Won' THEN estimated_value END")} AS won_revenue,
  {money("CASE WHEN state_code = 'Lost' THEN estimated_value END")} AS lost_revenue,
  {money("CASE WHEN state_code = 'Open' THEN weighted_amount END")} AS forecast_revenue,
  count(*) FILTER (WHERE state_code = 'Open') AS open_count,
  count(*) FILTER (WHERE state_code = 'Won') AS won_count,
  count(*) FILTER (WHERE state_code = 'Lost') AS lost_count
FROM fact_opportunity"""

ORACLES["funnel_kpis"] = with_(OPP_CTES, QUOTE_CTES) + """
SELECT o.n AS opportunity_count, q.n AS quote_count, c.n AS contract_count,
  CASE WHEN o.n > 0 THEN c.n / o.n END AS conversion_rate
FROM (SELECT count(*) AS n FROM fact_opportunity) o, (SELECT count(*) AS n FROM fact_quote) q,
     (SELECT count(*) AS n FROM fact_contract) c"""

ORACLES["activity_kpis"] = with_(ACTIVITY_CTES) + """
SELECT owner_id, count(*) FILTER (WHERE activity_type = 'phonecall') AS calls,
  count(*) FILTER (WHERE activity_type = 'appointment') AS meetings
FROM fact_activity GROUP BY owner_id"""

ORACLES["inactive_opportunities"] = with_(OPP_CTES, ACTIVITY_CTES) + f"""
SELECT opportunity_id, owner_id, stage_name, estimated_value FROM fact_opportunity f
WHERE state_code = 'Open' AND NOT EXISTS (
  SELECT 1 FROM fact_activity a WHERE a.opportunity_id = f.opportunity_id
    AND a.created_ts >= TIMESTAMP '{AS_OF_OPS}' - INTERVAL 7 DAY AND a.created_ts < TIMESTAMP '{AS_OF_OPS}')"""

ORACLES["weighted_forecast"] = with_(OPP_CTES) + f"""
SELECT expected_close_month, count(*) AS opportunity_count, {money('estimated_value')} AS pipeline_value,
  {money('weighted_amount')} AS weighted_value
FROM fact_opportunity WHERE state_code = 'Open' GROUP BY expected_close_month"""

ORACLES["dim_date"] = with_(OPP_CTES) + """
, bounds AS (SELECT min(d) AS lo, max(d) AS hi FROM (
    SELECT created_date AS d FROM fact_opportunity UNION ALL SELECT expected_close_date FROM fact_opportunity))
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS date_key, d AS date,
  month(d) AS month, quarter(d) AS quarter, year(d) AS year, isodow(d) AS weekday
FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds)"""

ORACLES["dim_sales_owner"] = with_(OWNER_CTES) + """
SELECT owner_id AS owner_key, owner_id, owner_name, region, department FROM owners"""

STAGE_STD = """
, staged AS (
  SELECT f.*, CASE WHEN state_code = 'Won' THEN 'Won' WHEN state_code = 'Lost' THEN 'Lost'
      WHEN state_code IN ('Closed', 'Canceled') THEN 'Closed'
      WHEN opportunity_id IN (SELECT opportunity_id FROM fact_quote) THEN 'Quoted'
      WHEN opportunity_id IN (SELECT opportunity_id FROM fact_activity WHERE opportunity_id IS NOT NULL) THEN 'In Progress'
      ELSE 'Open' END AS standard_stage
  FROM fact_opportunity f
)"""
STAGE_ORDER_SQL = """CASE {c} WHEN 'Open' THEN 1 WHEN 'In Progress' THEN 2 WHEN 'Quoted' THEN 3 WHEN 'Won' THEN 4
  WHEN 'Lost' THEN 5 WHEN 'Closed' THEN 6 END"""

ORACLES["stage_standardisation"] = with_(OPP_CTES, QUOTE_CTES, ACTIVITY_CTES) + STAGE_STD + """
SELECT opportunity_id, state_code, standard_stage FROM staged"""

ORACLES["dim_stage"] = with_(OPP_CTES, QUOTE_CTES, ACTIVITY_CTES) + STAGE_STD + f"""
SELECT {STAGE_ORDER_SQL.format(c='stage_name')} AS stage_key, stage_name,
  {STAGE_ORDER_SQL.format(c='stage_name')} AS stage_order
FROM (SELECT DISTINCT standard_stage AS stage_name FROM staged)"""

ORACLES["dim_activity_type"] = with_(ACTIVITY_CTES) + """
SELECT dense_rank() OVER (ORDER BY activity_type) AS activity_type_key, activity_type, activity_count
FROM (SELECT activity_type, count(*) AS activity_count FROM fact_activity GROUP BY activity_type)"""

LAST_ACTIVITY = """
, last_act AS (
  SELECT opportunity_id, CAST(max(coalesce(actual_end, created_ts)) AS DATE) AS last_activity_date
  FROM fact_activity WHERE opportunity_id IS NOT NULL GROUP BY opportunity_id
)"""

ORACLES["opportunity_star"] = with_(OPP_CTES, QUOTE_CTES, ACTIVITY_CTES, OWNER_CTES) + STAGE_STD + LAST_ACTIVITY + f"""
SELECT s.opportunity_id AS opportunity_key, o.owner_id AS owner_key,
  {STAGE_ORDER_SQL.format(c='s.standard_stage')} AS stage_key,
  CAST(year(created_date) * 10000 + month(created_date) * 100 + day(created_date) AS INTEGER) AS date_key,
  estimated_value AS amount, probability, weighted_amount, created_date, expected_close_date, last_activity_date
FROM staged s LEFT JOIN owners o ON s.owner_id = o.owner_id
  LEFT JOIN last_act a ON s.opportunity_id = a.opportunity_id"""

ORACLES["last_activity_date"] = with_(ACTIVITY_CTES) + LAST_ACTIVITY + "SELECT * FROM last_act"

ORACLES["activity_duration"] = with_(ACTIVITY_CTES) + """
SELECT activity_id, activity_type,
  CAST(epoch_us(scheduled_end) // 1000000 - epoch_us(scheduled_start) // 1000000 AS DOUBLE) / 60.0 AS activity_duration_minutes
FROM fact_activity"""

ORACLES["activity_opportunity_map"] = with_(ACTIVITY_CTES) + """
SELECT activity_id, opportunity_id, activity_type FROM fact_activity WHERE opportunity_id IS NOT NULL"""

STATE_SELECT = """SELECT user_id, event_id, modifiedon, change_operation, amount, event_type, bronze_op_type, is_active,
  silver_deleted_ts, silver_last_event_ts, silver_last_run_id, silver_updated_ts FROM {p}_state"""

ORACLES["cdc_classification"] = with_(ev_ctes()) + """
SELECT event_id, change_operation, bronze_op_type, bronze_op_type = 'DELETE' AS bronze_is_delete,
  'event_user' AS bronze_entity_name, 'bronze-events' AS bronze_pipeline_run_id,
  'dataverse_synapse_link' AS bronze_source_type, 'append_only' AS bronze_write_mode,
  'process_delete_events' AS bronze_delete_handling
FROM ev_bronze"""

ORACLES["latest_per_key"] = with_(ev_ctes()) + """
SELECT user_id, event_id, modifiedon, bronze_op_type, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY modifiedon DESC NULLS LAST,
    batch_ingest_ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM ev_valid) WHERE rn = 1"""

ORACLES["silver_current_state"] = with_(ev_ctes(), state_ctes("s")) + STATE_SELECT.format(p="s")
ORACLES["silver_incremental_merge"] = ORACLES["silver_current_state"]
ORACLES["silver_hard_delete"] = with_(ev_ctes(), state_ctes("s", hard=True)) + STATE_SELECT.format(p="s")
ORACLES["silver_backfill"] = with_(
    ev_ctes(where="batch_ingest_ts >= TIMESTAMP '2024-01-10 00:00:00' AND "
                  "batch_ingest_ts < TIMESTAMP '2024-01-20 00:00:00'"),
    state_ctes("s")) + STATE_SELECT.format(p="s")

ORACLES["change_feed"] = with_(
    ev_ctes(), "ev_old AS (SELECT * FROM ev_valid WHERE batch_date < DATE '2024-01-16')",
    state_ctes("o", src="ev_old"), state_ctes("n")) + """
SELECT coalesce(n.user_id, o.user_id) AS user_id,
  CASE WHEN o.user_id IS NULL THEN 'insert' WHEN n.user_id IS NULL THEN 'delete' ELSE 'update' END AS change_type,
  o.event_id AS old_event_id, o.is_active AS old_is_active, n.event_id AS new_event_id, n.is_active AS new_is_active
FROM o_state o FULL OUTER JOIN n_state n ON o.user_id = n.user_id
WHERE o.user_id IS NULL OR n.user_id IS NULL OR o.event_id IS DISTINCT FROM n.event_id
   OR o.is_active IS DISTINCT FROM n.is_active OR o.silver_deleted_ts IS DISTINCT FROM n.silver_deleted_ts"""

ORACLES["change_feed_of_runs"] = ORACLES["change_feed"]

ORACLES["stage_movement"] = with_(ev_ctes()) + """
, daily AS (
  SELECT user_id, batch_date AS snapshot_date, event_type AS stage_name, amount AS estimated_value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, batch_date ORDER BY modifiedon DESC NULLS LAST,
      event_id DESC NULLS LAST) AS rn FROM ev_valid WHERE NOT is_del) WHERE rn = 1
)
SELECT user_id, snapshot_date, stage_name, estimated_value,
  lag(stage_name) OVER w AS previous_stage, lag(estimated_value) OVER w AS previous_amount,
  estimated_value - lag(estimated_value) OVER w AS amount_change,
  CASE WHEN lag(stage_name) OVER w IS NULL THEN 'NEW' WHEN lag(stage_name) OVER w <> stage_name THEN 'MOVED'
       ELSE 'SAME' END AS movement
FROM daily WINDOW w AS (PARTITION BY user_id ORDER BY snapshot_date)"""

M_SEG = "CASE WHEN (segment IS NULL OR trim(segment) = '') THEN 'MANDATORY_NULL:segment' END"
M_KEY = "CASE WHEN (c_custkey IS NULL OR trim(CAST(c_custkey AS VARCHAR)) = '') THEN 'MANDATORY_NULL:c_custkey' END"
NEG = "CASE WHEN c_acctbal IS NOT NULL AND c_acctbal < 0 THEN 'NEGATIVE_VALUE:c_acctbal' END"


def n_nonnull(*exprs: str) -> str:
    return "(" + " + ".join(f"CASE WHEN ({e}) IS NULL THEN 0 ELSE 1 END" for e in exprs) + ")"


CUSTOMER_CTES = f"""
cust AS (
  SELECT c_custkey, c_name, c_nationkey, c_acctbal,
    CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_mktsegment = 'HOUSEHOLD' THEN ' ' ELSE c_mktsegment END
      AS segment
  FROM customer
),
cust_dq AS (
  SELECT *, concat_ws('|', {M_KEY}, {M_SEG}, {NEG}) AS reasons, {n_nonnull(M_KEY, M_SEG, NEG)} AS n_reasons
  FROM cust
)"""

ORACLES["dq_reasons"] = with_(CUSTOMER_CTES) + f"""
SELECT c_custkey, concat_ws('|', {M_SEG}, 'MISSING_COLUMN:c_phone', {NEG}) AS reasons,
  CAST({n_nonnull(M_SEG, NEG)} + 1 AS BIGINT) AS reason_count
FROM cust"""

ORACLES["dq_split"] = with_(CUSTOMER_CTES) + """
SELECT count(*) FILTER (WHERE n_reasons = 0) AS valid_rows, count(*) FILTER (WHERE n_reasons > 0) AS invalid_rows
FROM cust_dq"""

BAD = f"""
, bad AS (
  SELECT 'dq-customer' AS run_id, 'customer' AS entity_name, 'silver' AS layer_name,
    CAST(c_custkey AS VARCHAR) AS record_key, reasons AS failed_rule_name,
    reasons AS failure_reason, CAST(NULL AS VARCHAR) AS source_file_path,
    'quarantined' AS status, {OPS_RUN} AS quarantined_ts
  FROM cust_dq WHERE n_reasons > 0
)"""

ORACLES["bad_records"] = with_(CUSTOMER_CTES) + BAD + "SELECT * FROM bad"

ORACLES["quarantine_summary"] = with_(CUSTOMER_CTES) + BAD + """
SELECT entity_name, layer_name, failed_rule_name, status, CAST(quarantined_ts AS DATE) AS quarantine_date,
  count(*) AS quarantined_record_count, max(quarantined_ts) AS latest_quarantine_ts
FROM bad GROUP BY ALL"""

ORACLES["dq_positive_amount"] = with_(CUSTOMER_CTES) + """
SELECT c_custkey, 'NOT_POSITIVE:c_acctbal' AS reasons FROM cust WHERE c_acctbal IS NOT NULL AND c_acctbal <= 0"""

ORACLES["dq_date_order"] = """
SELECT l_orderkey * 10 + l_linenumber AS quoteid, l_shipdate, o_orderdate, 'DATE_ORDER:o_orderdate,l_shipdate' AS reasons
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
WHERE l_shipdate IS NOT NULL AND o_orderdate IS NOT NULL AND l_shipdate < o_orderdate"""

ORACLES["dq_owner_mandatory"] = """
SELECT count(*) FILTER (WHERE o_custkey IS NOT NULL AND o_orderkey IS NOT NULL) AS valid_rows,
  count(*) FILTER (WHERE o_custkey IS NULL OR o_orderkey IS NULL) AS invalid_rows FROM orders"""

ORACLES["dq_duplicate_keys"] = """
SELECT l_orderkey * 10 + l_linenumber AS quoteid, count(*) AS copies, 'DUPLICATE_KEY' AS reasons
FROM lineitem GROUP BY 1 HAVING count(*) > 1"""

ORACLES["dq_timeliness"] = with_(ev_ctes()) + """
SELECT event_id, user_id, 'LATE_ARRIVAL:modifiedon' AS reasons FROM ev_bronze
WHERE epoch_us(batch_ingest_ts) // 1000000 - epoch_us(modifiedon) // 1000000 > 43200"""

ORACLES["type_conformance"] = """
SELECT p_partkey, TRY_CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS p_size,
  CAST(TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DECIMAL(12,2)) AS DOUBLE) AS p_retailprice,
  TRY_CAST(p_brand AS INTEGER) AS p_brand, CAST(NULL AS VARCHAR) AS p_container,
  concat_ws('|', CASE WHEN p_brand IS NOT NULL AND TRY_CAST(p_brand AS INTEGER) IS NULL
                      THEN 'BAD_TYPE:p_brand' END) AS reasons
FROM part"""

SNAP = f"""
, snap AS (
  SELECT *, TIMESTAMP '{AS_OF_SALES}' AS snapshot_ts, DATE '{AS_OF_SALES[:10]}' AS snapshot_date,
    TIMESTAMP '{AS_OF_SALES}' AS snapshot_hour, 'daily' AS snapshot_grain, 'snapshot-20010801' AS snapshot_run_id,
    date_diff('day', created_date, DATE '{AS_OF_SALES[:10]}') AS days_open,
    date_diff('day', DATE '{AS_OF_SALES[:10]}', expected_close_date) AS days_to_expected_close
  FROM fact_opportunity
),
snap_b AS (
  SELECT *, CASE WHEN days_open <= 7 THEN '0-7 days' WHEN days_open <= 30 THEN '8-30 days'
    WHEN days_open <= 60 THEN '31-60 days' WHEN days_open <= 90 THEN '61-90 days' ELSE '90+ days' END
    AS pipeline_age_bucket FROM snap
)"""

ORACLES["opportunity_snapshot"] = with_(OPP_CTES) + SNAP + """
SELECT opportunity_id, snapshot_ts, snapshot_date, snapshot_hour, snapshot_grain, snapshot_run_id,
  CAST(days_open AS INTEGER) AS days_open, CAST(days_to_expected_close AS INTEGER) AS days_to_expected_close,
  pipeline_age_bucket FROM snap_b"""

ORACLES["snapshot_age_buckets"] = with_(OPP_CTES) + SNAP + f"""
SELECT pipeline_age_bucket, count(*) AS opportunity_count, {money('estimated_value')} AS pipeline_value
FROM snap_b GROUP BY 1"""

ORACLES["recent_runs"] = with_(RUN_CTES) + "SELECT * FROM runs ORDER BY created_ts DESC"
ORACLES["failed_runs"] = with_(RUN_CTES) + "SELECT * FROM runs WHERE status = 'failed' ORDER BY updated_ts DESC"

AGE = f"(epoch_us({{t}}) // 1000000 - epoch_us(updated_ts) // 1000000)"

ORACLES["layer_freshness"] = with_(RUN_CTES) + f"""
SELECT * EXCLUDE (rn), round({AGE.format(t=OPS_RUN)} / 60.0, 2) AS minutes_since_success FROM (
  SELECT *, row_number() OVER (PARTITION BY entity_name, layer_name ORDER BY updated_ts DESC, run_id DESC) AS rn
  FROM runs WHERE status IN ('success', 'partial_success')) WHERE rn = 1"""

ORACLES["health_summary"] = with_(RUN_CTES) + f"""
SELECT entity_name, layer_name, status AS latest_status, updated_ts AS latest_run_ts, source_row_count, rows_quarantined,
  CASE WHEN status = 'failed' THEN 'RED' WHEN status = 'partial_success' THEN 'AMBER'
       WHEN {AGE.format(t=OPS_RUN)} / 60.0 > 30 THEN 'AMBER' ELSE 'GREEN' END AS health_status
FROM (SELECT *, row_number() OVER (PARTITION BY entity_name, layer_name ORDER BY updated_ts DESC, run_id DESC) AS rn
      FROM runs) WHERE rn = 1"""

CURRENT_WM = """
, wm_cur AS (
  SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY entity_name, layer_name
    ORDER BY updated_ts DESC, run_id DESC) AS rn FROM watermarks) WHERE rn = 1
)"""

ORACLES["current_watermarks"] = with_(RUN_CTES) + CURRENT_WM + "SELECT * FROM wm_cur"

STALE = """
SELECT *, round({age} / 60.0, 2) AS minutes_since_watermark_update,
  CASE WHEN layer_name IN ('bronze', 'silver', 'gold') AND {age} / 60.0 > 30 THEN 'STALE_' || upper(layer_name)
       WHEN layer_name = 'gold_snapshot' AND {age} / 3600.0 > 26 THEN 'STALE_SNAPSHOT' ELSE 'OK' END AS freshness_status,
  {t} AS as_of
FROM wm_cur"""

ORACLES["stale_watermarks"] = with_(RUN_CTES) + CURRENT_WM + STALE.format(
    age=AGE.format(t=OPS_RUN), t=OPS_RUN) + "\nUNION ALL\n" + STALE.format(
    age=AGE.format(t=f"TIMESTAMP '{AS_OF_OPS_LATE}'"), t=f"TIMESTAMP '{AS_OF_OPS_LATE}'")

ORACLES["run_registry_fold"] = with_(RUN_CTES) + """
SELECT * REPLACE (run_end_ts AS updated_ts) FROM runs"""

ORACLES["run_metrics"] = with_(RUN_CTES) + """
SELECT entity_name, layer_name, count(*) AS runs,
  count(*) FILTER (WHERE status IN ('success', 'partial_success')) AS succeeded_runs,
  count(*) FILTER (WHERE status = 'failed') AS failed_runs,
  sum(source_row_count) AS rows_ingested, sum(rows_quarantined) AS rows_quarantined,
  avg(epoch_us(run_end_ts) // 1000000 - epoch_us(run_start_ts) // 1000000) AS avg_runtime_seconds,
  count(*) FILTER (WHERE status IN ('success', 'partial_success')) / count(*) AS success_rate
FROM runs GROUP BY ALL"""

ORACLES["bronze_stream"] = with_(ev_ctes()) + f"""
SELECT event_id, user_id, change_operation, bronze_op_type, bronze_op_type = 'DELETE' AS bronze_is_delete,
  'event_user' AS bronze_entity_name, 'bronze-stream' AS bronze_pipeline_run_id,
  DATE '{AS_OF_OPS[:10]}' AS ingestion_date, 'events.parquet' AS source_file_name
FROM ev_bronze"""

ORACLES["cdc_stream_state"] = with_(
    ev_ctes(batch="CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 0 ELSE 1 END",
            ingest=OPS_RUN,
            run="CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN 'stream-0' ELSE 'stream-1' END"),
    state_ctes("s")) + STATE_SELECT.format(p="s")

ORACLES["compacted_fact"] = with_(OPP_CTES) + """
SELECT opportunity_id, owner_id, state_code, estimated_value, created_date FROM fact_opportunity"""

ORACLES["gold_incremental_merge"] = with_(ev_ctes(), state_ctes("s")) + """
SELECT user_id, event_id, event_type, amount, modifiedon AS modified_ts, is_active,
  silver_last_event_ts AS source_event_ts, silver_last_run_id AS source_run_id,
  silver_updated_ts AS gold_source_updated_ts
FROM s_state WHERE is_active"""

FEED_SELECT = """SELECT opportunityid, name, ownerid, createdon, estimatedclosedate, estimatedvalue, closeprobability,
  statecode, stepname, CASE WHEN createdon >= TIMESTAMP '1998-01-01 00:00:00' THEN stepname END AS channel,
  '{fmt}' AS format FROM opp_feed"""

ORACLES["feed_formats"] = with_(OPP_CTES) + FEED_SELECT.format(fmt="json") + "\nUNION ALL\n" + \
    FEED_SELECT.format(fmt="csv")

ORACLES["medallion_jobs_fact"] = with_(OPP_CTES) + """
SELECT opportunity_id, opportunity_name, owner_id, created_ts, expected_close_date, estimated_value, probability,
  state_code, stage_name, weighted_amount, expected_close_month, is_active FROM fact_opportunity"""

# T4: the guarded merge, stated as windows. Per key, the first batch whose winner
# upserts creates the row; from then on a batch winner is applied iff its event
# time is >= every earlier winner's since creation (the guard compares with the
# stored time, which is the running maximum of applied changes).
ORACLES["silver_late_data"] = with_(ev_ctes(
    batch="CAST(ts AS DATE) + CASE WHEN value < 5.0 THEN 3 ELSE 0 END",
    ingest="CAST(CAST(ts AS DATE) + CASE WHEN value < 5.0 THEN 3 ELSE 0 END + 1 AS TIMESTAMP)",
    run="'silver-' || strftime(CAST(ts AS DATE) + CASE WHEN value < 5.0 THEN 3 ELSE 0 END, '%Y%m%d')")) + """
, w AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id, batch_date
      ORDER BY modifiedon DESC NULLS LAST, batch_ingest_ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM ev_valid) WHERE rn = 1
),
created AS (SELECT user_id, min(batch_date) AS cb FROM w WHERE NOT is_del GROUP BY user_id),
after AS (
  SELECT w.*, max(w.modifiedon) OVER (PARTITION BY w.user_id ORDER BY w.batch_date
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_max
  FROM w JOIN created c ON w.user_id = c.user_id AND w.batch_date >= c.cb
),
applied AS (SELECT * FROM after WHERE prev_max IS NULL OR modifiedon >= prev_max),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_date DESC) AS r
      FROM applied) WHERE r = 1),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY batch_date DESC) AS r
      FROM applied WHERE NOT is_del) WHERE r = 1)
SELECT u.user_id, u.event_id, u.modifiedon, u.change_operation, u.amount, u.event_type, u.bronze_op_type,
  NOT l.is_del AS is_active,
  CASE WHEN l.is_del THEN coalesce(l.modifiedon, l.batch_ingest_ts) END AS silver_deleted_ts,
  CASE WHEN l.is_del THEN l.modifiedon ELSE u.modifiedon END AS silver_last_event_ts,
  CASE WHEN l.is_del THEN l.batch_run_id ELSE u.batch_run_id END AS silver_last_run_id,
  CASE WHEN l.is_del THEN l.batch_ingest_ts ELSE u.batch_ingest_ts END AS silver_updated_ts
FROM u JOIN l ON u.user_id = l.user_id"""

ORACLES["schema_evolution"] = with_(OPP_CTES) + """
SELECT opportunityid, ownerid, modifiedon,
  CASE WHEN NOT (opportunityid % 3 = 2 AND opportunityid % 10 = 4) THEN estimatedvalue END AS estimatedvalue,
  'I' AS change_operation, opportunityid % 10 + CASE WHEN opportunityid % 3 = 2 THEN 0.5 ELSE 0 END::DOUBLE AS priority,
  CASE WHEN opportunityid % 3 > 0 THEN 'c' || (opportunityid % 10)::VARCHAR END AS channel,
  CASE WHEN opportunityid % 3 = 2 AND opportunityid % 10 = 4 THEN '{"estimatedvalue":"n/a"}' END AS rescued,
  'bronze-' || (opportunityid % 3)::VARCHAR AS bronze_pipeline_run_id, 'INSERT' AS bronze_op_type
FROM opp_feed"""

# one file for each drop; modifiedon is declared but left out of the rule, so it counts as new
ORACLES["landed_drift"] = with_(OPP_CTES) + """
, d AS (SELECT DISTINCT opportunityid % 3 AS i FROM opp_feed),
clash AS (SELECT count(*) AS n FROM opp_feed WHERE opportunityid % 3 = 2 AND opportunityid % 10 = 4)
SELECT column_name, 'NEW_COLUMN' AS change, CAST(NULL AS VARCHAR) AS expected_type, max(t) AS actual_type, count(*) AS files,
  min(TIMESTAMP '2024-01-01' + i * INTERVAL 1 DAY) AS first_landed
FROM (SELECT 'modifiedon' AS column_name, 'string' AS t, i FROM d
      UNION ALL SELECT 'priority', CASE WHEN i = 2 THEN 'double' ELSE 'bigint' END, i FROM d
      UNION ALL SELECT 'channel', 'string', i FROM d WHERE i > 0) GROUP BY column_name
UNION ALL
SELECT 'estimatedvalue', 'TYPE_CHANGED', 'double', 'string', 1, TIMESTAMP '2024-01-03' FROM clash WHERE n > 0"""

ORACLES["activity_incremental"] = with_(ACTIVITY_CTES) + """
SELECT activity_id, activity_type, owner_id AS activity_owner, CAST(coalesce(actual_end, created_ts) AS DATE) AS activity_date,
  CASE WHEN activity_type = 'phonecall' AND activity_id % 5 = 0 THEN 'Reopened' ELSE status_code END AS activity_status,
  opportunity_id AS related_opportunity
FROM fact_activity WHERE activity_id % 7 <> 0"""

_DATES = ("2024-01-05", "2024-01-10", "2024-01-15", "2024-01-20", "2024-01-25")
_SNAPS = with_(ev_ctes(), *(f"""
e{i} AS (SELECT * FROM ev_valid WHERE batch_date <= DATE '{d}'),{state_ctes(f"d{i}", src=f"e{i}")}""" for i, d in enumerate(_DATES))) + """
, snaps AS (
""" + " UNION ALL ".join(f"""
  SELECT user_id, DATE '{d}' AS snapshot_date, event_type AS stage_name, amount AS estimated_value FROM d{i}_state WHERE is_active"""
                         for i, d in enumerate(_DATES)) + ")"

ORACLES["snapshot_movement"] = _SNAPS + """
SELECT user_id, snapshot_date, stage_name, estimated_value,
  lag(stage_name) OVER w AS previous_stage, lag(estimated_value) OVER w AS previous_amount,
  estimated_value - lag(estimated_value) OVER w AS amount_change,
  CASE WHEN lag(stage_name) OVER w IS NULL THEN 'NEW' WHEN lag(stage_name) OVER w <> stage_name THEN 'MOVED'
       ELSE 'SAME' END AS movement
FROM snaps WINDOW w AS (PARTITION BY user_id ORDER BY snapshot_date)"""

ORACLES["pipeline_trend"] = _SNAPS + """
, t AS (
  SELECT snapshot_date, stage_name, count(*) AS opportunity_count,
    CAST(round(sum(CAST(estimated_value AS DECIMAL(28,6))), 2) AS DOUBLE) AS pipeline_value
  FROM snaps WHERE day(snapshot_date) BETWEEN 8 AND 22 GROUP BY snapshot_date, stage_name)
SELECT snapshot_date, stage_name, opportunity_count, pipeline_value,
  opportunity_count - lag(opportunity_count) OVER w AS count_change,
  round(pipeline_value - lag(pipeline_value) OVER w, 2) AS value_change
FROM t WINDOW w AS (PARTITION BY stage_name ORDER BY snapshot_date)"""

ORACLES["z_ordered_fact"] = ORACLES["compacted_fact"]
