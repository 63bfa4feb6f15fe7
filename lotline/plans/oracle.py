"""DuckDB oracle: the same queries restated in plain SQL.

The SQL follows the reference's own formulations where they differ from
ours (ten aggregate-then-join branches for the lifecycle, LAG/LEAD windows
for the history, a brute-force ``contains`` scan for the matcher), so the
check compares two independent derivations.  Half-even rounding is done
with integer arithmetic, because DuckDB turns decimal division into double.
"""

from __future__ import annotations

# Written out here, so that the check does not share its constants with the code it checks.
AS_OF = "2001-09-01"
EVENT_STAGES = ("signup", "view", "click", "purchase", "error")
STAGES = ("PURCHASED", "SHIPPED", "AT_PORT", "CLEARED", "PICKED_UP", "AT_OFFICE", "INSPECTING", "IN_REPAIR", "CLEANED", "LISTED", "SOLD")
EVENT_RULES = (
    ("PICKUP", ("picked up", "picking up")),
    ("OFFICE_ARRIVAL", ("arrived", "at the office")),
    ("REPAIR_PROGRESS", ("fixed", "bumper", "headlight", "repair", "working on")),
    ("CUSTOMS_UPDATE", ("held", "duty", "customs")),
)

A = f"DATE '{AS_OF}'"
RUN = f"TIMESTAMP '{AS_OF} 00:00:00'"
CUT = "TIMESTAMP '2024-01-15 00:00:00'"


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def dk(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def half_even(n: str, d: int) -> str:
    """round(n / d) ties to even, for a non-negative integer expression n."""
    return (f"(({n}) // {d} + CASE WHEN 2 * (({n}) % {d}) > {d} OR (2 * (({n}) % {d}) = {d} "
            f"AND (({n}) // {d}) % 2 = 1) THEN 1 ELSE 0 END)")


def _list(xs) -> str:
    return "[" + ", ".join(q(x) for x in xs) + "]"


def _classify(t: str) -> str:
    parts = [f"WHEN {t} IS NULL THEN 'IGNORE'"]
    for label, words in EVENT_RULES:
        cond = " OR ".join(f"contains(lower({t}), {q(w)})" for w in words)
        parts.append(f"WHEN {cond} THEN {q(label)}")
    return "CASE " + " ".join(parts) + " ELSE 'IGNORE' END"


# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


cte("vehicle", f"""
SELECT o.o_orderkey AS vehicle_id, printf('VIN%014d', o.o_orderkey) AS vin,
       CASE WHEN o.o_orderstatus = 'P' THEN printf('Hall %d/P', o.o_orderkey) ELSE printf('LOT-%05d', o.o_orderkey) END AS auction_lot_no, o.o_orderpriority AS make, c.c_name AS model,
       CAST(year(o.o_orderdate) AS INTEGER) AS model_year, CAST(c.c_nationkey AS BIGINT) AS branch_id,
       CASE WHEN o.o_orderstatus = 'F' THEN 'SOLD' WHEN o.o_orderstatus = 'P' THEN 'LISTED' ELSE 'IN_REPAIR' END AS current_stage,
       CASE WHEN o.o_orderstatus = 'F' THEN 'SOLD' ELSE 'ACTIVE' END AS current_status,
       o.o_orderdate AS created_at, o.o_orderdate AS updated_at, o.o_totalprice < 10000 AS is_deleted,
       CASE WHEN o.o_totalprice < 10000 THEN o.o_orderdate END AS deleted_at
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")

cte("dim_vehicle", """
SELECT ROW_NUMBER() OVER (ORDER BY vehicle_id) AS vehicle_key, vehicle_id, vin, make, model, model_year, branch_id,
       current_stage AS stage, current_status AS status, created_at AS effective_from,
       CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM vehicle WHERE NOT is_deleted""", "vehicle")

cte("purchase", """
SELECT o_orderkey AS purchase_id, o_orderkey AS vehicle_id, CAST(n_regionkey AS BIGINT) AS auction_house_id,
       o_custkey AS buyer_staff_id, CAST(o_totalprice AS DECIMAL(14,2)) AS price_amount,
       'USD' AS price_currency, CAST(o_orderdate AS DATE) AS purchase_date, CAST(left(o_orderpriority, 1) AS BIGINT) AS source_id
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey""")

cte("sale", """
SELECT o.o_orderkey AS sale_id, o.o_orderkey AS vehicle_id, o.o_custkey AS customer_id,
       o.o_custkey AS salesperson_staff_id, n.agreed_price, n.sale_date,
       CASE WHEN o.o_orderstatus = 'F' THEN 'FINALIZED' WHEN o.o_orderstatus = 'P' THEN 'PENDING_PAYMENT'
            ELSE 'REVERSED' END AS status, CAST(left(o.o_orderpriority, 1) AS BIGINT) AS source_id
FROM orders o JOIN (
  SELECT l_orderkey,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(14,2)) AS agreed_price,
         MAX(CAST(l_shipdate AS DATE)) AS sale_date
  FROM lineitem GROUP BY l_orderkey) n ON o.o_orderkey = n.l_orderkey""")

cte("repair_job_part", """
SELECT l_orderkey * 100 + l_linenumber AS line_id, l_orderkey AS repair_job_id, l_partkey AS part_id,
       l_suppkey AS vendor_id, CAST(l_quantity AS INTEGER) AS qty,
       CAST(CAST((2 * CAST(round(l_extendedprice * 100) AS BIGINT) + CAST(l_quantity AS BIGINT))
                 // (2 * CAST(l_quantity AS BIGINT)) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2)) AS unit_cost,
       l_shipdate AS created_at
FROM lineitem""")

cte("plan", """
SELECT o_orderkey AS vehicle_id, o_custkey AS customer_key, CAST(o_orderdate AS DATE) AS purchase_date,
       most AS shipping_days, n_lines AS clear_days, returned AS delayed, least AS extra_days,
       o_orderpriority AS hold_reason_draw, all_done AS passed_first, 2 * n_lines AS repair_days,
       disc >= 10 AS blocked, o_orderstatus <> 'P' AS passed_second, tax >= 8 AS redo,
       120 + disc + tax AS markup_pct, most AS sale_days, disc, o_orderpriority = '1-URGENT' AS installment,
       CAST(left(o_orderpriority, 1) AS BIGINT) AS source_id
FROM orders JOIN (
  SELECT l_orderkey, CAST(COUNT(*) AS INTEGER) AS n_lines, CAST(MAX(l_quantity) AS INTEGER) AS most,
         CAST(MIN(l_quantity) AS INTEGER) AS least, bool_or(l_returnflag = 'R') AS returned,
         bool_and(l_linestatus = 'F') AS all_done, CAST(round(MAX(l_discount) * 100) AS INTEGER) AS disc,
         CAST(round(MAX(l_tax) * 100) AS INTEGER) AS tax
  FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey""")

cte("shipment", f"""
SELECT *, purchase_date + 2 AS etd, purchase_date + 2 + shipping_days AS eta,
       CASE WHEN {A} - purchase_date >= shipping_days + 2 THEN purchase_date + 2 + shipping_days END AS ata,
       CASE WHEN {A} - purchase_date >= shipping_days + 2 THEN 'ARRIVED' ELSE 'IN_TRANSIT' END AS shipment_status
FROM plan WHERE {A} - purchase_date >= 2""", "plan")

cte("port_arrival", f"""
SELECT *,
       CASE WHEN {A} - arrival_date >= total_clear THEN 'CLEARED' WHEN delayed THEN 'ON_HOLD' ELSE 'PENDING' END AS clearance_status,
       CASE WHEN {A} - arrival_date >= total_clear THEN arrival_date + total_clear END AS cleared_date,
       CASE WHEN delayed THEN hold_reason_draw END AS hold_reason
FROM (SELECT *, ata AS arrival_date, clear_days + CASE WHEN delayed THEN extra_days ELSE 0 END AS total_clear
      FROM shipment WHERE shipment_status = 'ARRIVED')""", "shipment")

cte("intake", f"""
SELECT *, cleared_date + 1 AS pickup_date, cleared_date + 1 AS intake_date
FROM port_arrival WHERE clearance_status = 'CLEARED' AND {A} - cleared_date >= 1""", "port_arrival")

cte("inspection_r1", f"""
SELECT *, intake_date + 1 AS inspection_date, 1 AS round_no,
       CASE WHEN passed_first THEN 'PASS' ELSE 'FAIL' END AS overall_result, vehicle_id * 10 + 1 AS inspection_id
FROM intake WHERE {A} - intake_date >= 1""", "intake")

cte("repair_chain", f"""
SELECT *,
       CASE WHEN es >= repair_days AND NOT blocked THEN 'DONE'
            WHEN blocked AND es < repair_days + 15 THEN 'BLOCKED_PARTS'
            WHEN es >= repair_days * 0.4 THEN 'IN_PROGRESS' ELSE 'OPEN' END AS repair_status,
       CASE WHEN es >= repair_days AND NOT blocked THEN start_date + repair_days END AS end_date
FROM (SELECT *, inspection_date + 1 AS start_date, {A} - (inspection_date + 1) AS es
      FROM inspection_r1 WHERE overall_result = 'FAIL' AND round_no = 1 AND {A} - inspection_date >= 1)""",
    "inspection_r1")

cte("repair_job", f"""
SELECT vehicle_id AS repair_job_id, vehicle_id, customer_key AS mechanic_staff_id,
       start_date, end_date, repair_status AS status, source_id
FROM repair_chain""", "repair_chain")

cte("inspection", f"""
SELECT inspection_id, vehicle_id, inspection_date, overall_result, round_no FROM inspection_r1
UNION ALL
SELECT vehicle_id * 10 + 2, vehicle_id, end_date + 1, CASE WHEN passed_second THEN 'PASS' ELSE 'FAIL' END, 2
FROM repair_chain WHERE repair_status = 'DONE' AND {A} - end_date >= 1""", "inspection_r1", "repair_chain")

cte("latest_passed", """
SELECT vehicle_id, inspection_date FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY vehicle_id ORDER BY round_no DESC, inspection_id DESC) AS rn
  FROM inspection) WHERE rn = 1 AND overall_result = 'PASS'""", "inspection")

cte("cleaning_task", f"""
SELECT lp.vehicle_id AS cleaning_id, lp.vehicle_id, lp.inspection_date + 1 AS task_date,
       CASE WHEN p.redo THEN 'REDO_REQUIRED' ELSE 'DONE' END AS status
FROM latest_passed lp JOIN plan p ON lp.vehicle_id = p.vehicle_id
WHERE {A} - lp.inspection_date >= 1""", "latest_passed", "plan")

cte("repair_cost", """
SELECT j.vehicle_id, SUM(l.unit_cost * l.qty) AS repair_cost
FROM repair_job_part l JOIN repair_job j ON l.repair_job_id = j.repair_job_id GROUP BY j.vehicle_id""",
    "repair_job_part", "repair_job")

# list price: cost in cents x markup in hundredths = raw x 10^4; step 5000 -> 5 x 10^7 units
cte("listing", f"""
SELECT vehicle_id AS listing_id, vehicle_id, listed_date,
       CAST({half_even('raw_u', 50000000)} * 5000 AS DECIMAL(14,2)) AS price_amount
FROM (SELECT c.vehicle_id, c.task_date + 1 AS listed_date,
             (CAST(COALESCE(u.usd, 0) * 100 AS HUGEINT) * 1600 + CAST(COALESCE(rc.repair_cost, 0) * 100 AS HUGEINT))
               * p.markup_pct AS raw_u
      FROM cleaning_task c JOIN plan p ON c.vehicle_id = p.vehicle_id
      LEFT JOIN (SELECT vehicle_id, MAX(price_amount) AS usd FROM purchase GROUP BY vehicle_id) u ON c.vehicle_id = u.vehicle_id
      LEFT JOIN repair_cost rc ON c.vehicle_id = rc.vehicle_id
      WHERE c.status = 'DONE' AND {A} - c.task_date >= 1)""", "cleaning_task", "plan", "purchase", "repair_cost")

cte("matured", f"""
SELECT vehicle_id, listed_date + sale_days AS sale_date,
       CAST({half_even('x5', 100000)} AS DECIMAL(14,2)) AS agreed_price, installment
FROM (SELECT l.vehicle_id, l.listed_date, p.sale_days,
             CAST(l.price_amount * 100 AS HUGEINT) * (1000 - 10 * p.disc) AS x5, p.installment
      FROM listing l JOIN plan p ON l.vehicle_id = p.vehicle_id)
WHERE {A} - listed_date >= sale_days""", "listing", "plan")

# dimensions
cte("dim_staff", f"""
SELECT ROW_NUMBER() OVER (ORDER BY c.c_custkey) AS staff_key, c.c_custkey AS staff_id, c.c_name AS name,
       CAST(c.c_nationkey AS BIGINT) AS branch_id, r.primary_role, {RUN} AS effective_from,
       CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current
FROM customer c LEFT JOIN (
  SELECT staff_id, MIN(role_code) AS primary_role FROM (
    SELECT c_custkey AS staff_id, c_mktsegment AS role_code FROM customer
    UNION ALL SELECT c_custkey, 'INSPECTOR' FROM customer WHERE c_acctbal < 0)
  GROUP BY staff_id) r ON c.c_custkey = r.staff_id""")

cte("data_source", """
SELECT CAST(DENSE_RANK() OVER (ORDER BY source_code) AS BIGINT) AS source_id, source_code FROM (
  SELECT DISTINCT upper(event_type) AS source_code FROM events
  UNION SELECT 'WHATSAPP_GROUP_AGENT' UNION SELECT 'RECEIPT_AGENT')""")
cte("dim_source", "SELECT ROW_NUMBER() OVER (ORDER BY source_id) AS source_key, source_id, source_code FROM data_source",
    "data_source")
cte("dim_auction_house", """
SELECT ROW_NUMBER() OVER (ORDER BY r_regionkey) AS auction_house_key, CAST(r_regionkey AS BIGINT) AS auction_house_id,
       r_name AS name, CAST(NULL AS VARCHAR) AS country FROM region""")
cte("dim_branch", """
SELECT ROW_NUMBER() OVER (ORDER BY n_nationkey) AS branch_key, CAST(n_nationkey AS BIGINT) AS branch_id,
       n_name AS name, TRUE AS is_active FROM nation""")
cte("dim_part", """
SELECT ROW_NUMBER() OVER (ORDER BY p_partkey) AS part_key, p_partkey AS part_id, p_name AS name, p_type AS category
FROM part""")
cte("dim_vendor", "SELECT ROW_NUMBER() OVER (ORDER BY s_suppkey) AS vendor_key, s_suppkey AS vendor_id, s_name AS name FROM supplier")
cte("dim_customer", """
SELECT ROW_NUMBER() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id, c_name AS name,
       CAST(NULL AS VARCHAR) AS phone FROM customer""")

FX = "CAST(1600.0000 AS DECIMAL(10,4))"

cte("fact_purchase_full", f"""
SELECT dv.vehicle_key, ah.auction_house_key, st.staff_key AS buyer_staff_key, br.branch_key,
       {dk('p.purchase_date')} AS purchase_date_key, src.source_key,
       CAST(p.price_amount AS DOUBLE) AS price_amount_usd,
       CAST(CAST(p.price_amount * {FX} AS DECIMAL(20,2)) AS DOUBLE) AS price_amount_ngn,
       CAST(1600 AS DOUBLE) AS fx_rate_used
FROM purchase p JOIN dim_vehicle dv ON p.vehicle_id = dv.vehicle_id
LEFT JOIN dim_auction_house ah ON p.auction_house_id = ah.auction_house_id
LEFT JOIN dim_staff st ON p.buyer_staff_id = st.staff_id
LEFT JOIN dim_branch br ON dv.branch_id = br.branch_id
LEFT JOIN dim_source src ON p.source_id = src.source_id""",
    "purchase", "dim_vehicle", "dim_auction_house", "dim_staff", "dim_branch", "dim_source")

cte("fact_repair_full", f"""
SELECT dv.vehicle_key, st.staff_key AS mechanic_staff_key, pt.part_key, vd.vendor_key, br.branch_key,
       {dk('j.start_date')} AS repair_start_date_key, {dk('j.end_date')} AS repair_end_date_key, src.source_key,
       l.qty, CAST(l.unit_cost AS DOUBLE) AS unit_cost_ngn, CAST(l.unit_cost * l.qty AS DOUBLE) AS line_cost_ngn
FROM repair_job_part l JOIN repair_job j ON l.repair_job_id = j.repair_job_id
JOIN dim_vehicle dv ON j.vehicle_id = dv.vehicle_id
LEFT JOIN dim_staff st ON j.mechanic_staff_id = st.staff_id
LEFT JOIN dim_part pt ON l.part_id = pt.part_id
LEFT JOIN dim_vendor vd ON l.vendor_id = vd.vendor_id
LEFT JOIN dim_branch br ON dv.branch_id = br.branch_id
LEFT JOIN dim_source src ON j.source_id = src.source_id""",
    "repair_job_part", "repair_job", "dim_vehicle", "dim_staff", "dim_part", "dim_vendor", "dim_branch", "dim_source")

cte("fact_sale_full", f"""
SELECT dv.vehicle_key, cu.customer_key, st.staff_key AS salesperson_staff_key, br.branch_key,
       {dk('s.sale_date')} AS sale_date_key, src.source_key, CAST(s.agreed_price AS DOUBLE) AS agreed_price_ngn, s.status
FROM sale s JOIN dim_vehicle dv ON s.vehicle_id = dv.vehicle_id
LEFT JOIN dim_customer cu ON s.customer_id = cu.customer_id
LEFT JOIN dim_staff st ON s.salesperson_staff_id = st.staff_id
LEFT JOIN dim_branch br ON dv.branch_id = br.branch_id
LEFT JOIN dim_source src ON s.source_id = src.source_id""",
    "sale", "dim_vehicle", "dim_customer", "dim_staff", "dim_branch", "dim_source")


def _profit_sql(lines_filter: str = "TRUE", ts: str = RUN) -> str:
    return f"""
SELECT dv.vehicle_key,
       COALESCE(pc.purchase_cost, 0) + COALESCE(rc.repair_cost, 0) AS total_cost_ngn,
       rv.revenue AS total_revenue_ngn,
       CASE WHEN rv.revenue IS NOT NULL THEN rv.revenue - (COALESCE(pc.purchase_cost, 0) + COALESCE(rc.repair_cost, 0)) END AS profit_ngn,
       CASE WHEN rv.revenue IS NOT NULL AND rv.revenue <> 0 THEN
         round(CAST(rv.revenue - (COALESCE(pc.purchase_cost, 0) + COALESCE(rc.repair_cost, 0)) AS DOUBLE)
               / CAST(rv.revenue AS DOUBLE) * 100, 2) END AS margin_pct,
       {ts} AS calculated_at
FROM dim_vehicle dv
LEFT JOIN (SELECT d.vehicle_key, SUM(CAST(p.price_amount * {FX} AS DECIMAL(20,2))) AS purchase_cost
           FROM purchase p JOIN dim_vehicle d ON p.vehicle_id = d.vehicle_id GROUP BY d.vehicle_key) pc
       ON dv.vehicle_key = pc.vehicle_key
LEFT JOIN (SELECT d.vehicle_key, SUM(l.unit_cost * l.qty) AS repair_cost
           FROM repair_job_part l JOIN repair_job j ON l.repair_job_id = j.repair_job_id
           JOIN dim_vehicle d ON j.vehicle_id = d.vehicle_id WHERE {lines_filter} GROUP BY d.vehicle_key) rc
       ON dv.vehicle_key = rc.vehicle_key
LEFT JOIN (SELECT d.vehicle_key, MAX(s.agreed_price) AS revenue
           FROM sale s JOIN dim_vehicle d ON s.vehicle_id = d.vehicle_id
           WHERE s.status IN ('FINALIZED', 'PENDING_PAYMENT') GROUP BY d.vehicle_key) rv
       ON dv.vehicle_key = rv.vehicle_key"""


PROFIT_DEPS = ("dim_vehicle", "purchase", "repair_job_part", "repair_job", "sale")
cte("fact_profit", _profit_sql(), *PROFIT_DEPS)
cte("fact_profit_early", _profit_sql("l.created_at < TIMESTAMP '1998-01-01 00:00:00'",
                                     "TIMESTAMP '2001-01-01 00:00:00'"), *PROFIT_DEPS)

# the first state of the tables that are refreshed: half prices of the first source, pending sales booked as reversed
cte("fact_profit_first", _profit_sql("l.created_at < TIMESTAMP '1998-01-01 00:00:00'", "TIMESTAMP '2001-01-01 00:00:00'")
    .replace("CAST(p.price_amount *", "CAST(CASE WHEN p.source_id = 1 THEN CAST((CAST(round(p.price_amount * 100) AS BIGINT) + 1) // 2 AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) ELSE p.price_amount END *")
    .replace("IN ('FINALIZED', 'PENDING_PAYMENT')", "= 'FINALIZED'"), *PROFIT_DEPS)

cte("lifecycle", f"""
SELECT dv.vehicle_key,
       {dk('pd.purchase_date')} AS purchase_date_key, {dk('sd.ship_date')} AS ship_date_key,
       {dk('pa.port_arrival_date')} AS port_arrival_date_key, {dk('pa.cleared_date')} AS cleared_date_key,
       {dk('pu.pickup_date')} AS pickup_date_key, {dk('oi.office_intake_date')} AS office_intake_date_key,
       {dk('ins.first_inspection_date')} AS first_inspection_date_key,
       {dk('ins.inspection_pass_date')} AS inspection_pass_date_key, ins.inspection_rounds_count,
       {dk('rp.repair_start_date')} AS repair_start_date_key, {dk('rp.repair_end_date')} AS repair_end_date_key,
       {dk('cl.cleaning_complete_date')} AS cleaning_complete_date_key, {dk('li.listed_date')} AS listed_date_key,
       {dk('sa.sold_date')} AS sold_date_key,
       CAST(pa.port_arrival_date - pd.purchase_date AS INTEGER) AS days_purchase_to_port,
       CAST(pa.cleared_date - pa.port_arrival_date AS INTEGER) AS days_port_to_clearance,
       CAST(pu.pickup_date - pa.cleared_date AS INTEGER) AS days_clearance_to_pickup,
       CAST(oi.office_intake_date - pu.pickup_date AS INTEGER) AS days_pickup_to_intake,
       CAST(ins.first_inspection_date - oi.office_intake_date AS INTEGER) AS days_intake_to_inspection,
       CAST(rp.repair_end_date - ins.first_inspection_date AS INTEGER) AS days_inspection_to_repair_complete,
       CAST(cl.cleaning_complete_date - rp.repair_end_date AS INTEGER) AS days_repair_to_cleaning,
       CAST(li.listed_date - cl.cleaning_complete_date AS INTEGER) AS days_cleaning_to_listed,
       CAST(sa.sold_date - li.listed_date AS INTEGER) AS days_listed_to_sold,
       CAST(sa.sold_date - pd.purchase_date AS INTEGER) AS total_days_purchase_to_sale,
       v.current_stage, v.updated_at AS last_updated_at
FROM dim_vehicle dv JOIN vehicle v ON dv.vehicle_id = v.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(purchase_date) AS purchase_date FROM purchase GROUP BY 1) pd ON v.vehicle_id = pd.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(etd) AS ship_date FROM shipment GROUP BY 1) sd ON v.vehicle_id = sd.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(arrival_date) AS port_arrival_date,
                  MAX(CASE WHEN clearance_status = 'CLEARED' THEN cleared_date END) AS cleared_date
           FROM port_arrival GROUP BY 1) pa ON v.vehicle_id = pa.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(pickup_date) AS pickup_date FROM intake GROUP BY 1) pu ON v.vehicle_id = pu.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(intake_date) AS office_intake_date FROM intake GROUP BY 1) oi ON v.vehicle_id = oi.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(CASE WHEN round_no = 1 THEN inspection_date END) AS first_inspection_date,
                  MAX(CASE WHEN overall_result = 'PASS' THEN inspection_date END) AS inspection_pass_date,
                  MAX(round_no) AS inspection_rounds_count
           FROM inspection GROUP BY 1) ins ON v.vehicle_id = ins.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(start_date) AS repair_start_date,
                  MAX(CASE WHEN status = 'DONE' THEN end_date END) AS repair_end_date
           FROM repair_job GROUP BY 1) rp ON v.vehicle_id = rp.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(task_date) AS cleaning_complete_date FROM cleaning_task WHERE status = 'DONE'
           GROUP BY 1) cl ON v.vehicle_id = cl.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(listed_date) AS listed_date FROM listing GROUP BY 1) li ON v.vehicle_id = li.vehicle_id
LEFT JOIN (SELECT vehicle_id, MIN(sale_date) AS sold_date FROM sale GROUP BY 1) sa ON v.vehicle_id = sa.vehicle_id""",
    "dim_vehicle", "vehicle", "purchase", "shipment", "port_arrival", "intake", "inspection", "repair_job",
    "cleaning_task", "listing", "sale")

_ev_ord = "list_position(" + _list(EVENT_STAGES) + ", event_type)"
cte("events_history", f"""
SELECT ROW_NUMBER() OVER (ORDER BY user_id, CAST(ts AS DATE), {_ev_ord}, event_id) AS history_id,
       user_id AS vehicle_id,
       LAG(event_type) OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), {_ev_ord}, event_id) AS from_stage,
       event_type AS to_stage, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS changed_at,
       CAST(1 AS BIGINT) AS source_id, CAST(NULL AS VARCHAR) AS source_record_id
FROM events""")

_stage_ord = "list_position(" + _list(STAGES) + ", stage)"
cte("vehicle_events", """
SELECT vehicle_id, 'PURCHASED' AS stage, purchase_date AS d FROM purchase
UNION ALL SELECT vehicle_id, 'SHIPPED', etd FROM shipment
UNION ALL SELECT vehicle_id, 'AT_PORT', arrival_date FROM port_arrival
UNION ALL SELECT vehicle_id, 'CLEARED', cleared_date FROM port_arrival WHERE clearance_status = 'CLEARED'
UNION ALL SELECT vehicle_id, 'PICKED_UP', pickup_date FROM intake
UNION ALL SELECT vehicle_id, 'AT_OFFICE', intake_date FROM intake
UNION ALL SELECT vehicle_id, 'INSPECTING', inspection_date FROM inspection WHERE round_no = 1
UNION ALL SELECT vehicle_id, 'IN_REPAIR', start_date FROM repair_job
UNION ALL SELECT vehicle_id, 'CLEANED', task_date FROM cleaning_task WHERE status = 'DONE'
UNION ALL SELECT vehicle_id, 'LISTED', listed_date FROM listing
UNION ALL SELECT vehicle_id, 'SOLD', sale_date FROM sale""",
    "purchase", "shipment", "port_arrival", "intake", "inspection", "repair_job", "cleaning_task", "listing", "sale")

cte("vehicle_history", f"""
SELECT ROW_NUMBER() OVER (ORDER BY vehicle_id, d, {_stage_ord}) AS history_id, vehicle_id,
       LAG(stage) OVER (PARTITION BY vehicle_id ORDER BY d, {_stage_ord}) AS from_stage, stage AS to_stage,
       CAST(d AS TIMESTAMP) AS changed_at, CAST(1 AS BIGINT) AS source_id, CAST(NULL AS VARCHAR) AS source_record_id
FROM vehicle_events WHERE d IS NOT NULL""", "vehicle_events")

cte("vehicle_synced", f"""
SELECT v.vehicle_id, COALESCE(u.last_stage, v.current_stage) AS current_stage,
       CASE WHEN u.vehicle_id IS NULL THEN v.current_status WHEN u.last_stage = 'SOLD' THEN 'SOLD' ELSE 'ACTIVE' END AS current_status,
       CASE WHEN u.vehicle_id IS NULL THEN v.updated_at ELSE {RUN} END AS updated_at
FROM vehicle v LEFT JOIN (SELECT vehicle_id, arg_max(to_stage, history_id) AS last_stage FROM vehicle_history
                          GROUP BY vehicle_id) u ON v.vehicle_id = u.vehicle_id""", "vehicle", "vehicle_history")

# triage
cte("order_message", """
SELECT o.o_orderkey AS message_id,
       concat_ws(' ', CASE o.o_orderpriority WHEN '1-URGENT' THEN 'arrived' WHEN '2-HIGH' THEN 'customs' WHEN '3-MEDIUM' THEN 'fixed'
                           WHEN '4-NOT SPECIFIED' THEN 'picked up' END,
                 CASE WHEN o.o_orderstatus = 'O' THEN concat_ws(' ', o.o_orderpriority, c.c_name)
                      ELSE CASE WHEN o.o_orderstatus = 'P' THEN printf('Hall %d/P', o.o_orderkey) ELSE printf('LOT-%05d', o.o_orderkey) END END) AS message_text
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")

cte("raw_message", """
SELECT message_id, message_text FROM order_message
UNION ALL
SELECT (SELECT MAX(o_orderkey) FROM orders) + ROW_NUMBER() OVER (ORDER BY t.conv_id NULLS FIRST, t.turn NULLS FIRST),
       concat_ws(' ', m.message_text, t.text)
FROM conversations t LEFT JOIN order_message m ON t.conv_id = m.message_id""", "order_message")

cte("typed", f"SELECT message_id, message_text, {_classify('message_text')} AS event_type FROM raw_message",
    "raw_message")

cte("lot_hit", """
SELECT t.message_id, MIN(v.vehicle_id) AS lot_vehicle_id
FROM typed t JOIN vehicle v ON v.auction_lot_no IS NOT NULL AND length(v.auction_lot_no) > 0
                           AND contains(t.message_text, v.auction_lot_no)
WHERE t.event_type <> 'IGNORE' GROUP BY t.message_id""", "typed", "vehicle")

cte("name_hit", """
SELECT t.message_id, COUNT(*) AS n, MIN(v.vehicle_id) AS min_id
FROM typed t JOIN vehicle v ON v.make IS NOT NULL AND v.model IS NOT NULL AND length(v.make) > 0
     AND length(v.model) > 0 AND contains(lower(t.message_text), lower(v.make))
     AND contains(lower(t.message_text), lower(v.model))
WHERE t.event_type <> 'IGNORE' AND t.message_id NOT IN (SELECT message_id FROM lot_hit)
GROUP BY t.message_id""", "typed", "vehicle", "lot_hit")

cte("extracted_event", """
SELECT message_id AS event_id, message_id,
       CASE WHEN event_type = 'IGNORE' THEN NULL WHEN lot_vehicle_id IS NOT NULL THEN lot_vehicle_id
            WHEN COALESCE(n, 0) = 1 THEN min_id END AS vehicle_id,
       event_type, json_object('raw_text', message_text)::VARCHAR AS extracted_fields, confidence_score,
       CASE WHEN confidence_score >= 0.85 THEN 'AUTO_ACCEPTED' WHEN event_type = 'IGNORE' THEN 'AUTO_REJECTED'
            ELSE 'PENDING' END AS review_status,
       CAST(NULL AS BIGINT) AS reviewed_by_staff_id
FROM (SELECT t.*, l.lot_vehicle_id, h.n, h.min_id,
             CASE WHEN t.event_type = 'IGNORE' THEN 0.10 WHEN l.lot_vehicle_id IS NOT NULL THEN 0.95
                  WHEN COALESCE(h.n, 0) = 1 THEN 0.60 WHEN COALESCE(h.n, 0) > 1 THEN 0.35 ELSE 0.30 END::DOUBLE
               AS confidence_score
      FROM typed t LEFT JOIN lot_hit l ON t.message_id = l.message_id
      LEFT JOIN name_hit h ON t.message_id = h.message_id)""", "typed", "lot_hit", "name_hit")

cte("receipt_line", """
SELECT p.purchase_id AS line_id, p.vehicle_id,
       CASE WHEN o.o_orderstatus = 'F' THEN p.price_amount ELSE COALESCE(l.total, p.price_amount) END AS amount
FROM purchase p JOIN orders o ON p.purchase_id = o.o_orderkey
LEFT JOIN (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(14,2)) AS total FROM lineitem
           GROUP BY l_orderkey) l ON p.purchase_id = l.l_orderkey""", "purchase")

cte("receipt_scored", """
SELECT r.line_id, r.vehicle_id, r.amount,
       CASE WHEN EXISTS (SELECT 1 FROM purchase p WHERE p.vehicle_id = r.vehicle_id AND p.price_amount = r.amount)
            THEN 0.92 ELSE 0.55 END::DOUBLE AS confidence_score
FROM receipt_line r""", "receipt_line", "purchase")

cte("receipt_gated", """
SELECT *, CASE WHEN confidence_score >= 0.85 THEN 'AUTO_ACCEPTED' ELSE 'PENDING' END AS review_status
FROM receipt_scored""", "receipt_scored")

MADE = "TIMESTAMP '1995-01-01 06:30:00'"
cte("ev_tasks", f"""
SELECT ROW_NUMBER() OVER (ORDER BY event_id) AS task_id, 'EXTRACTED_EVENT' AS source_type, event_id AS source_id,
       CAST(1 AS BIGINT) AS assigned_to_staff_id, {MADE} AS created_at
FROM extracted_event WHERE review_status = 'PENDING'""", "extracted_event")

cte("review_task", f"""
SELECT t.task_id, t.source_type, t.source_id, t.assigned_to_staff_id,
       CASE WHEN r.l_orderkey IS NULL THEN 'OPEN' ELSE 'RESOLVED' END AS status, t.created_at, r.last_line AS resolved_at
FROM (SELECT * FROM ev_tasks
      UNION ALL
      SELECT (SELECT COALESCE(MAX(task_id), 0) FROM ev_tasks) + ROW_NUMBER() OVER (ORDER BY line_id),
             'EXTRACTED_RECEIPT_LINE', line_id, CAST(1 AS BIGINT), {MADE}
      FROM receipt_gated WHERE review_status = 'PENDING') t
LEFT JOIN (SELECT l_orderkey, MAX(l_shipdate) AS last_line FROM lineitem
           WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey) r
     ON t.source_id = r.l_orderkey""", "ev_tasks", "receipt_gated")

cte("review_queue", f"""
SELECT t.task_id AS task_key, src.source_key, st.staff_key AS assigned_staff_key,
       {dk('t.created_at')} AS created_date_key, {dk('t.resolved_at')} AS resolved_date_key,
       CASE WHEN t.source_type = 'EXTRACTED_EVENT' THEN e.confidence_score ELSE r.confidence_score END AS confidence_score,
       epoch(t.resolved_at - t.created_at) / 3600.0 AS resolution_hours, t.status
FROM review_task t
LEFT JOIN extracted_event e ON t.source_type = 'EXTRACTED_EVENT' AND t.source_id = e.event_id
LEFT JOIN receipt_scored r ON t.source_type <> 'EXTRACTED_EVENT' AND t.source_id = r.line_id
LEFT JOIN dim_staff st ON t.assigned_to_staff_id = st.staff_id
LEFT JOIN dim_source src ON src.source_code =
     CASE WHEN t.source_type = 'EXTRACTED_EVENT' THEN 'WHATSAPP_GROUP_AGENT' ELSE 'RECEIPT_AGENT' END""",
    "review_task", "extracted_event", "receipt_scored", "dim_staff", "dim_source")

# SCD2 from the events change log
cte("scd2_versions", """
SELECT ROW_NUMBER() OVER (ORDER BY user_id, ts, event_id) AS version_key, user_id, event_type,
       ts AS effective_from, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS effective_to,
       LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events)
WHERE rn = 1 OR prev_type IS DISTINCT FROM event_type""")

cte("scd2_early", f"""
SELECT ROW_NUMBER() OVER (ORDER BY user_id, ts, event_id) AS version_key, user_id, event_type,
       ts AS effective_from, LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS effective_to,
       LEAD(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL AS is_current
FROM (SELECT *, LAG(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_type,
             ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
      FROM events WHERE ts < {CUT})
WHERE rn = 1 OR prev_type IS DISTINCT FROM event_type""")

cte("scd2_batch", f"""
SELECT user_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events WHERE ts >= {CUT} GROUP BY user_id""")

T2 = "TIMESTAMP '2024-01-31 00:00:00'"
cte("scd2_applied", f"""
SELECT version_key, user_id, event_type, effective_from, effective_to, is_current FROM scd2_early WHERE NOT is_current
UNION ALL
SELECT d.version_key, d.user_id, d.event_type, d.effective_from,
       CASE WHEN b.user_id IS NOT NULL AND b.event_type IS DISTINCT FROM d.event_type THEN {T2} ELSE d.effective_to END,
       NOT (b.user_id IS NOT NULL AND b.event_type IS DISTINCT FROM d.event_type)
FROM scd2_early d LEFT JOIN scd2_batch b ON d.user_id = b.user_id WHERE d.is_current
UNION ALL
SELECT (SELECT MAX(version_key) FROM scd2_early) + ROW_NUMBER() OVER (ORDER BY b.user_id), b.user_id, b.event_type,
       {T2}, CAST(NULL AS TIMESTAMP), TRUE
FROM scd2_batch b LEFT JOIN scd2_early d ON d.user_id = b.user_id AND d.is_current
WHERE d.user_id IS NULL OR b.event_type IS DISTINCT FROM d.event_type""", "scd2_early", "scd2_batch")


def sql(final: str, *needs: str) -> str:
    """WITH <needed ctes in dependency order> <final>."""
    order: list[str] = []

    def visit(n: str):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final.strip()
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][0]}\n)" for n in order) + "\n" + final.strip()


def _quarantine() -> str:
    """Every rule as a window or a subquery over its whole table."""
    tables = {
        "vehicle": ("(SELECT * FROM vehicle WHERE NOT is_deleted)", "vehicle_id"), "branch": ("(SELECT n_nationkey AS branch_id, n_name AS name FROM nation)", "branch_id"),
        "staff": ("(SELECT c_custkey AS staff_id, c_name AS name, c_nationkey AS branch_id FROM customer)", "staff_id"),
        "part": ("(SELECT p_partkey AS part_id, p_name AS name FROM part)", "part_id"), "vendor": ("(SELECT s_suppkey AS vendor_id, s_name AS name FROM supplier)", "vendor_id"),
        "purchase": ("purchase", "purchase_id"), "sale": ("sale", "sale_id"), "repair_job": ("repair_job", "repair_job_id"), "repair_job_part": ("repair_job_part", "line_id")}
    null = lambda *cs: [(f"not_null:{c}", f"{c} IS NULL") for c in cs]
    key = lambda *cs: [(f"unique:{','.join(cs)}", " AND ".join(f"{c} IS NOT NULL" for c in cs) + f" AND COUNT(*) OVER (PARTITION BY {', '.join(cs)}) > 1")]
    ref = lambda c, parent: [(f"reference:{c}", f"{c} IS NOT NULL AND {c} NOT IN (SELECT {tables[parent][1]} FROM {tables[parent][0]})")]
    one_of = lambda c, *values: [(f"allowed:{c}", f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(q(v) for v in values)})")]
    rules = {
        "vehicle": null("vehicle_id", "branch_id") + key("vin") + key("make", "model", "model_year") + ref("branch_id", "branch"),
        "branch": null("branch_id", "name") + key("name"), "staff": null("staff_id", "name") + key("staff_id") + ref("branch_id", "branch"),
        "part": null("part_id", "name"), "vendor": null("vendor_id", "name") + key("name"),
        "purchase": null("vehicle_id", "price_amount") + key("purchase_id") + one_of("price_currency", "USD", "NGN") + ref("vehicle_id", "vehicle") + ref("buyer_staff_id", "staff"),
        "sale": null("vehicle_id", "customer_id") + key("sale_id") + one_of("status", "FINALIZED", "PENDING_PAYMENT") + ref("vehicle_id", "vehicle") + ref("salesperson_staff_id", "staff"),
        "repair_job": null("vehicle_id", "start_date") + key("repair_job_id") + one_of("status", "COMPLETED", "IN_PROGRESS", "PENDING", "BLOCKED_WAITING_PART") + ref("vehicle_id", "vehicle"),
        "repair_job_part": null("qty", "unit_cost") + key("line_id") + ref("repair_job_id", "repair_job") + ref("part_id", "part") + ref("vendor_id", "vendor")}
    parts = []
    for name, (table, row_key) in tables.items():
        cases = ", ".join(f"CASE WHEN {test} THEN {q(reason)} END" for reason, test in sorted(rules[name]))
        judged = f"(SELECT {row_key} AS row_key, concat_ws(';', {cases}) AS reasons FROM {table})"
        parts.append(f"SELECT {q(name)} AS \"table\", CAST(row_key AS BIGINT) AS row_key, reasons, CAST(NULL AS BIGINT) AS clean FROM {judged} WHERE reasons <> ''")
        parts.append(f"SELECT {q(name)}, NULL, NULL, COUNT(*) FROM {judged} WHERE reasons = ''")
    return "\nUNION ALL ".join(parts)


def _status_report() -> str:
    reports = {"shipment": ("shipment", ["shipment_status"]), "clearance": ("port_arrival", ["clearance_status"]), "inspection": ("inspection", ["round_no", "overall_result"]),
               "repair": ("repair_job", ["status"]), "cleaning": ("cleaning_task", ["status"]), "sale": ("sale", ["status"]), "vehicle": ("vehicle", ["current_stage", "current_status"])}
    parts = []
    for name, (table, keys) in reports.items():
        for n, level in ([(2, 0), (1, 1), (0, 3)] if len(keys) == 2 else [(1, 0), (0, 3)]):
            cols = [f"CAST({k} AS VARCHAR)" for k in keys[:n]] + ["CAST(NULL AS VARCHAR)"] * (2 - n)
            by = f" GROUP BY {', '.join(keys[:n])}" if n else ""
            parts.append(f"SELECT {q(name)} AS report, {cols[0]} AS key1, {cols[1]} AS key2, {level} AS level, COUNT(*) AS count FROM {table}{by}")
    return "\nUNION ALL ".join(parts)


def _money(cols: str) -> str:
    return cols


ORACLE: dict[str, str] = {
    "dim_date_orders": sql("""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, dayname(d) AS day_of_week,
       CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(month(d) AS INTEGER) AS month_no,
       monthname(d) AS month_name, CAST(quarter(d) AS INTEGER) AS quarter, CAST(year(d) AS INTEGER) AS year,
       isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(CAST(MIN(o_orderdate) AS DATE), CAST(MAX(o_orderdate) AS DATE),
                                         INTERVAL 1 DAY)) AS DATE) AS d FROM orders)"""),
    "dim_vehicle": sql("SELECT * FROM dim_vehicle", "dim_vehicle"),
    "dim_staff": sql("SELECT * FROM dim_staff", "dim_staff"),
    "dim_part": sql("SELECT * FROM dim_part", "dim_part"),
    "dim_customer": sql("SELECT * FROM dim_customer", "dim_customer"),
    "dim_vendor": sql("SELECT * FROM dim_vendor", "dim_vendor"),
    "dim_data_source": sql("SELECT * FROM dim_source", "dim_source"),
    "dim_branch": sql("SELECT * FROM dim_branch", "dim_branch"),
    "dim_auction_house": sql("SELECT * FROM dim_auction_house", "dim_auction_house"),
    "status_cleaning": sql("SELECT status, COUNT(*) AS count FROM cleaning_task GROUP BY 1", "cleaning_task"),
    "status_listing": sql("""
SELECT CASE WHEN s.vehicle_id IS NOT NULL THEN 'SOLD' ELSE 'ACTIVE' END AS status, COUNT(*) AS count
FROM listing l LEFT JOIN (SELECT DISTINCT vehicle_id FROM sale WHERE status IN ('FINALIZED', 'PENDING_PAYMENT')) s
     ON l.vehicle_id = s.vehicle_id GROUP BY 1""", "listing", "sale"),
    "first_purchases": sql("""
SELECT vehicle_id, CAST(price_amount AS DOUBLE) AS price_amount, purchase_date FROM purchase
ORDER BY vehicle_id LIMIT 10""", "purchase"),
    "landed_events": sql(f"""
SELECT *, {RUN} AS ingested_at, 'events.parquet' AS source_file FROM events"""),
    "fact_purchase": sql("SELECT * FROM fact_purchase_full", "fact_purchase_full"),
    "fact_repair": sql("SELECT * FROM fact_repair_full", "fact_repair_full"),
    "fact_sale": sql("SELECT * FROM fact_sale_full", "fact_sale_full"),
    "fact_profit": sql("""
SELECT vehicle_key, CAST(total_cost_ngn AS DOUBLE) AS total_cost_ngn, CAST(total_revenue_ngn AS DOUBLE) AS total_revenue_ngn,
       CAST(profit_ngn AS DOUBLE) AS profit_ngn, margin_pct, calculated_at FROM fact_profit""", "fact_profit"),
    "profit_summary": sql("""
SELECT COUNT(*) AS vehicles_sold, CAST(SUM(total_revenue_ngn) AS DOUBLE) AS total_revenue_ngn,
       CAST(SUM(total_cost_ngn) AS DOUBLE) AS total_cost_ngn, CAST(SUM(profit_ngn) AS DOUBLE) AS total_profit_ngn,
       round(AVG(margin_pct), 2) AS avg_margin_pct
FROM fact_profit WHERE profit_ngn IS NOT NULL""", "fact_profit"),
    "top_profits": sql("""
SELECT vehicle_key, CAST(total_cost_ngn AS DOUBLE) AS total_cost_ngn, CAST(total_revenue_ngn AS DOUBLE) AS total_revenue_ngn,
       CAST(profit_ngn AS DOUBLE) AS profit_ngn, margin_pct
FROM fact_profit WHERE profit_ngn IS NOT NULL ORDER BY profit_ngn DESC NULLS LAST, vehicle_key LIMIT 10""",
                       "fact_profit"),
    "profit_history_append": sql("""
SELECT profit_history_key, vehicle_key, CAST(total_cost_ngn AS DOUBLE) AS total_cost_ngn,
       CAST(profit_ngn AS DOUBLE) AS profit_ngn, reason FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY vehicle_key) AS profit_history_key, vehicle_key, total_cost_ngn, profit_ngn,
         'initial calculation' AS reason FROM fact_profit_early
  UNION ALL
  SELECT (SELECT COUNT(*) FROM fact_profit_early) + ROW_NUMBER() OVER (ORDER BY n.vehicle_key), n.vehicle_key,
         n.total_cost_ngn, n.profit_ngn, 'late repair costs'
  FROM fact_profit n LEFT JOIN fact_profit_early o ON n.vehicle_key = o.vehicle_key
  WHERE o.vehicle_key IS NULL OR n.total_cost_ngn IS DISTINCT FROM o.total_cost_ngn
     OR n.total_revenue_ngn IS DISTINCT FROM o.total_revenue_ngn OR n.profit_ngn IS DISTINCT FROM o.profit_ngn)""",
                                 "fact_profit", "fact_profit_early"),
    "fact_expense": sql(f"""
SELECT dv.vehicle_key,
       CAST(CASE l.l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 ELSE 4 END AS BIGINT) AS category_key,
       {dk('CAST(l.l_shipdate AS DATE)')} AS expense_date_key,
       src.source_key,
       CAST(CAST(CAST(l.l_extendedprice AS DECIMAL(14,2)) * CAST(l.l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2)) AS DOUBLE) AS amount_ngn,
       'NGN' AS currency
FROM lineitem l LEFT JOIN dim_vehicle dv ON l.l_orderkey = dv.vehicle_id
LEFT JOIN dim_source src ON l.l_linenumber = src.source_id""", "dim_vehicle", "dim_source"),
    "fact_vehicle_lifecycle": sql("SELECT * FROM lifecycle", "lifecycle"),
    "avg_cycle_days": sql("""
SELECT AVG(total_days_purchase_to_sale) AS avg_days_purchase_to_sale FROM lifecycle WHERE current_stage = 'SOLD'""",
                          "lifecycle"),
    "top_longest_cycles": sql("""
SELECT vehicle_key, current_stage, total_days_purchase_to_sale FROM lifecycle
ORDER BY total_days_purchase_to_sale DESC NULLS LAST, vehicle_key LIMIT 10""", "lifecycle"),
    "stage_history_events": sql("SELECT * FROM events_history", "events_history"),
    "stage_history_vehicles": sql("SELECT * FROM vehicle_history", "vehicle_history"),
    "vehicle_stage_sync": sql("SELECT * FROM vehicle_synced", "vehicle_synced"),
    "time_in_stage": sql("""
SELECT h.to_stage AS stage, h.history_id, h.vehicle_id, h.changed_at AS entered_at,
       COALESCE(LEAD(h.changed_at) OVER (PARTITION BY h.vehicle_id ORDER BY h.history_id),
                TIMESTAMP '2024-01-31 00:00:00') AS left_at,
       CAST(CAST(COALESCE(LEAD(h.changed_at) OVER (PARTITION BY h.vehicle_id ORDER BY h.history_id),
                          TIMESTAMP '2024-01-31 00:00:00') AS DATE) - CAST(h.changed_at AS DATE) AS INTEGER) AS days_in_stage,
       s.sla_days,
       CAST(CAST(COALESCE(LEAD(h.changed_at) OVER (PARTITION BY h.vehicle_id ORDER BY h.history_id),
                          TIMESTAMP '2024-01-31 00:00:00') AS DATE) - CAST(h.changed_at AS DATE) AS INTEGER) > s.sla_days
         AS sla_breached
FROM events_history h LEFT JOIN (VALUES ('signup', 3), ('view', 2), ('click', 2), ('purchase', 5), ('error', 1))
     s(stage, sla_days) ON h.to_stage = s.stage""", "events_history"),
    "listing_sold_sync": sql(f"""
SELECT l.listing_id, l.vehicle_id, CAST(l.price_amount AS DOUBLE) AS price_amount, 'NGN' AS currency, l.listed_date,
       CASE WHEN s.vehicle_id IS NOT NULL THEN 'SOLD' ELSE 'ACTIVE' END AS status,
       CASE WHEN s.vehicle_id IS NOT NULL THEN {RUN} ELSE CAST(l.listed_date AS TIMESTAMP) END AS updated_at
FROM listing l LEFT JOIN (SELECT DISTINCT vehicle_id FROM sale WHERE status IN ('FINALIZED', 'PENDING_PAYMENT')) s
     ON l.vehicle_id = s.vehicle_id""", "listing", "sale"),
    "status_shipment": sql("SELECT shipment_status, COUNT(*) AS count FROM shipment GROUP BY 1", "shipment"),
    "status_clearance": sql("SELECT clearance_status, COUNT(*) AS count FROM port_arrival GROUP BY 1", "port_arrival"),
    "status_inspection": sql("SELECT round_no, overall_result, COUNT(*) AS count FROM inspection GROUP BY 1, 2",
                             "inspection"),
    "status_repair": sql("SELECT status, COUNT(*) AS count FROM repair_job GROUP BY 1", "repair_job"),
    "status_sale": sql("SELECT status, COUNT(*) AS count FROM sale GROUP BY 1", "sale"),
    "status_dim_vehicle": sql("SELECT stage, status, COUNT(*) AS count FROM dim_vehicle GROUP BY 1, 2", "dim_vehicle"),
    "shipments": sql("SELECT vehicle_id, etd, eta, ata, shipment_status FROM shipment", "shipment"),
    "port_arrivals": sql("SELECT vehicle_id, arrival_date, clearance_status, cleared_date, hold_reason FROM port_arrival",
                         "port_arrival"),
    "pickups": sql("SELECT vehicle_id, pickup_date, intake_date FROM intake", "intake"),
    "inspection_results": sql("""
SELECT i.inspection_id, it.item_id, CASE WHEN f.item_id IS NOT NULL THEN 'FAIL' ELSE 'PASS' END AS pass_fail
FROM inspection i CROSS JOIN (SELECT CAST(range AS BIGINT) AS item_id FROM range(1, 9)) it
LEFT JOIN (SELECT DISTINCT r.inspection_id, l.l_linenumber AS item_id
           FROM inspection_r1 r JOIN lineitem l ON r.vehicle_id = l.l_orderkey
           WHERE r.overall_result = 'FAIL' AND l.l_linestatus = 'O') f
     ON i.inspection_id = f.inspection_id AND it.item_id = f.item_id""", "inspection", "inspection_r1"),
    "damage_items": sql("""
SELECT r.inspection_id * 10 + l.l_linenumber AS damage_id, r.inspection_id, CAST(l.l_linenumber AS BIGINT) AS item_id,
       MIN(l.l_partkey) AS part_id,
       CASE MAX(l.l_returnflag) WHEN 'N' THEN 'LOW' WHEN 'A' THEN 'MEDIUM' WHEN 'R' THEN 'HIGH' END AS severity
FROM inspection_r1 r JOIN lineitem l ON r.vehicle_id = l.l_orderkey
WHERE r.overall_result = 'FAIL' AND l.l_linestatus = 'O' GROUP BY r.inspection_id, l.l_linenumber""", "inspection_r1"),
    "repair_jobs": sql("SELECT * FROM repair_job", "repair_job"),
    "latest_passed": sql("SELECT * FROM latest_passed", "latest_passed"),
    "cleaning_tasks": sql("SELECT * FROM cleaning_task", "cleaning_task"),
    "repair_cost": sql("SELECT vehicle_id, CAST(repair_cost AS DOUBLE) AS repair_cost FROM repair_cost", "repair_cost"),
    "listings": sql("SELECT listing_id, vehicle_id, CAST(price_amount AS DOUBLE) AS price_amount, listed_date FROM listing",
                    "listing"),
    "matured_sales": sql("SELECT vehicle_id, sale_date, CAST(agreed_price AS DOUBLE) AS agreed_price FROM matured",
                         "matured"),
    "first_payments": sql(f"""
SELECT vehicle_id, CASE WHEN installment THEN 'PENDING_PAYMENT' ELSE 'FINALIZED' END AS sale_status,
       CAST(CASE WHEN installment THEN {half_even('CAST(agreed_price AS HUGEINT) * 5', 10)} ELSE agreed_price END AS DOUBLE)
         AS payment_amount
FROM matured""", "matured"),
    "extracted_event": sql("SELECT * FROM extracted_event", "extracted_event"),
    "receipt_scores": sql("""
SELECT line_id, vehicle_id, CAST(amount AS DOUBLE) AS amount, confidence_score, review_status FROM receipt_gated""",
                          "receipt_gated"),
    # rounds over all pairs: those that are best for both sides are matched and leave
    "receipt_matches": """
WITH RECURSIVE bought AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(14,2)) AS amount, o_orderstatus FROM orders),
line AS (
  SELECT b.id, b.day, CASE WHEN o_orderstatus = 'F' THEN b.amount ELSE COALESCE(l.total, b.amount) END AS amount
  FROM bought b LEFT JOIN (SELECT l_orderkey, CAST(SUM(CAST(l_extendedprice AS DECIMAL(14,2))) AS DECIMAL(14,2)) AS total
                           FROM lineitem GROUP BY l_orderkey) l ON b.id = l.l_orderkey),
pair AS (
  SELECT r.id AS rid, p.id AS pid, r.amount AS a, p.amount AS b, abs(r.amount - p.amount) AS gap
  FROM line r JOIN bought p ON r.day = p.day AND abs(r.amount - p.amount) <= CAST(p.amount AS DOUBLE) * 0.05),
step(n, rid, pid, a, b, gap, hit) AS (
  SELECT 0, rid, pid, a, b, gap, false FROM pair
  UNION ALL
  SELECT n + 1, rid, pid, a, b, gap,
         row_number() OVER (PARTITION BY rid ORDER BY gap, b, pid) = 1 AND row_number() OVER (PARTITION BY pid ORDER BY gap, a, rid) = 1
  FROM step s
  WHERE NOT hit AND NOT EXISTS (SELECT 1 FROM step h WHERE h.hit AND h.rid = s.rid)
    AND NOT EXISTS (SELECT 1 FROM step h WHERE h.hit AND h.pid = s.pid))
SELECT l.id AS line_id, m.pid AS purchase_id, CAST(l.amount AS DOUBLE) AS amount, CAST(m.b AS DOUBLE) AS price_amount
FROM line l LEFT JOIN (SELECT rid, pid, b FROM step WHERE hit) m ON l.id = m.rid""",
    "review_tasks": sql("SELECT * FROM review_task", "review_task"),
    "fact_review_queue": sql("SELECT * FROM review_queue", "review_queue"),
    "review_kpis": sql("""
SELECT source_key, status, COUNT(*) AS tasks, round(AVG(confidence_score), 4) AS avg_confidence,
       COUNT(resolved_date_key) AS resolved, round(AVG(resolution_hours), 2) AS avg_resolution_hours
FROM review_queue GROUP BY 1, 2""", "review_queue"),
    "status_review": sql("SELECT source_type, status, COUNT(*) AS count FROM review_task GROUP BY 1, 2", "review_task"),
    "scd2_user_versions": sql("SELECT * FROM scd2_versions", "scd2_versions"),
    "scd2_apply_batch": sql("SELECT * FROM scd2_applied", "scd2_applied"),
    "state_as_of": sql(f"""
SELECT user_id, event_type, effective_from FROM scd2_versions
WHERE effective_from <= {CUT} AND (effective_to IS NULL OR {CUT} < effective_to)""", "scd2_versions"),
    "fact_profit_incremental": sql("""
SELECT n.vehicle_key, CAST(n.total_cost_ngn AS DOUBLE) AS total_cost_ngn, CAST(n.total_revenue_ngn AS DOUBLE) AS total_revenue_ngn,
       CAST(n.profit_ngn AS DOUBLE) AS profit_ngn, n.margin_pct,
       CASE WHEN n.total_cost_ngn IS DISTINCT FROM o.total_cost_ngn OR n.total_revenue_ngn IS DISTINCT FROM o.total_revenue_ngn
            THEN n.calculated_at ELSE o.calculated_at END AS calculated_at
FROM fact_profit n LEFT JOIN fact_profit_first o ON n.vehicle_key = o.vehicle_key""", "fact_profit", "fact_profit_first"),
    "contract_quarantine": sql(_quarantine(), "vehicle", "purchase", "sale", "repair_job", "repair_job_part"),
    "status_report": sql(_status_report(), "shipment", "port_arrival", "inspection", "repair_job", "cleaning_task", "sale", "vehicle"),
    "stage_duration_quantiles": sql("""
SELECT event_type, s.share::DOUBLE AS share, n AS rows, micros AS quantile FROM (
  SELECT event_type, micros, ROW_NUMBER() OVER (PARTITION BY event_type ORDER BY micros) AS place, COUNT(*) OVER (PARTITION BY event_type) AS n
  FROM (SELECT event_type, epoch_us(effective_to) - epoch_us(effective_from) AS micros FROM scd2_versions WHERE effective_to IS NOT NULL))
JOIN (VALUES (0.5), (0.9), (0.99)) s(share) ON place = greatest(1, CAST(ceil(s.share * n) AS BIGINT))""", "scd2_versions"),
    "landed_rejected": sql("""
SELECT CASE WHEN event_type NOT IN ('error', 'signup') THEN event_id END AS event_id, CASE WHEN event_type = 'click' THEN user_id END AS user_id,
       CASE WHEN event_type NOT IN ('error', 'signup') THEN event_type END AS event_type,
       CASE WHEN event_type = 'click' THEN printf('d%d', user_id % 7) END AS device,
       CASE event_type WHEN 'error' THEN printf('{"event_id":%d,"user_id":', event_id)
                       WHEN 'signup' THEN printf('{"event_id":%d,"user_id":"user %d","event_type":"signup"}', event_id, user_id) END AS record,
       CASE event_type WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'type:user_id' END AS reason
FROM events"""),
    "payload_items": sql("""
SELECT event_id, user_id AS u, unnest(CASE WHEN event_type IN ('view', 'error') THEN [NULL] ELSE regexp_split_to_array(event_type, '[cs]') END) AS part FROM events"""),
    "stage_stock_by_day": sql("""
SELECT s.stage, d.day, COUNT(*) FILTER (h.entered = d.day) AS entered, COUNT(*) FILTER (h.gone = d.day) AS "left",
       COUNT(*) FILTER (h.entered <= d.day AND (h.gone IS NULL OR h.gone > d.day)) AS in_stage
FROM (SELECT DISTINCT to_stage AS stage FROM vehicle_history) s
CROSS JOIN (SELECT CAST(unnest(generate_series((SELECT CAST(MIN(changed_at) AS DATE) FROM vehicle_history),
                                               (SELECT CAST(MAX(changed_at) AS DATE) FROM vehicle_history), INTERVAL 1 DAY)) AS DATE) AS day) d
JOIN (SELECT to_stage, CAST(changed_at AS DATE) AS entered,
             CAST(LEAD(changed_at) OVER (PARTITION BY vehicle_id ORDER BY history_id) AS DATE) AS gone FROM vehicle_history) h
  ON h.to_stage = s.stage GROUP BY 1, 2""", "vehicle_history"),
    "state_as_of_join": sql("""
SELECT t.event_id, t.user_id, t.asked_at, v.event_type AS state, v.version_key
FROM (SELECT event_id, user_id, ts - INTERVAL 1 DAY AS asked_at FROM events) t
ASOF LEFT JOIN scd2_versions v ON t.user_id = v.user_id AND t.asked_at >= v.effective_from""", "scd2_versions"),
    "scd2_late_changes": sql("SELECT user_id, event_type, effective_from, effective_to, is_current FROM scd2_versions", "scd2_versions"),
    "dedup_messages": sql("""
SELECT conv_id, turn, role, text || ' (edited)' AS text, TIMESTAMP '2024-01-02 00:00:00' AS ingested_at
FROM (SELECT DISTINCT conv_id, turn, role, text FROM conversations)"""),
    "upsert_vehicles": sql("""
SELECT vehicle_id, CASE WHEN updated_at > TIMESTAMP '1998-01-01 00:00:00' THEN current_stage || '_LOADED' ELSE current_stage END AS current_stage,
       current_status, updated_at
FROM vehicle""", "vehicle"),
    "soft_delete_reversed": sql(f"""
SELECT v.vehicle_id, v.is_deleted OR s.vehicle_id IS NOT NULL AS is_deleted,
       CASE WHEN s.vehicle_id IS NOT NULL THEN {RUN} ELSE v.deleted_at END AS deleted_at
FROM vehicle v LEFT JOIN (SELECT DISTINCT vehicle_id FROM sale WHERE status = 'REVERSED') s ON v.vehicle_id = s.vehicle_id""",
                                "vehicle", "sale"),
    "source_mix_by_branch_and_date": sql("""
SELECT entity, branch_id, day, source_id, COUNT(*) AS records,
       round(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY entity, branch_id, day), 2) AS pct_of_records
FROM (SELECT 'purchase' AS entity, v.branch_id, purchase_date AS day, source_id FROM purchase JOIN vehicle v USING (vehicle_id)
      UNION ALL SELECT 'sale', v.branch_id, sale_date, source_id FROM sale JOIN vehicle v USING (vehicle_id))
GROUP BY 1, 2, 3, 4""", "purchase", "sale", "vehicle"),
    "customers_by_name": sql("""
SELECT ROW_NUMBER() OVER w AS name_key, c_mktsegment, c_name, LAG(c_name) OVER w AS prev_name, LEAD(c_name) OVER w AS next_name
FROM customer WINDOW w AS (ORDER BY c_mktsegment, c_name)"""),
    "sold_by_date": sql("""
SELECT sold_date, o_orderkey, ROW_NUMBER() OVER (ORDER BY sold_date NULLS FIRST, o_orderkey) AS sale_no
FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS sold_date, o_orderkey FROM orders)"""),
    "status_sale_ordered": sql("""
SELECT status, COUNT(*) AS count, ROW_NUMBER() OVER (ORDER BY COUNT(*) DESC, status) AS place FROM sale GROUP BY status""", "sale"),
    "fact_profit_with_expenses": sql("""
SELECT vehicle_key, CAST(cost AS DOUBLE) AS total_cost_ngn, CAST(total_revenue_ngn AS DOUBLE) AS total_revenue_ngn,
       CAST(total_revenue_ngn - cost AS DOUBLE) AS profit_ngn,
       CASE WHEN total_revenue_ngn <> 0 THEN round(CAST(total_revenue_ngn - cost AS DOUBLE) / CAST(total_revenue_ngn AS DOUBLE) * 100, 2) END AS margin_pct,
       calculated_at
FROM (SELECT p.*, p.total_cost_ngn + COALESCE(e.expenses, 0) AS cost FROM fact_profit p LEFT JOIN (
        SELECT dv.vehicle_key, SUM(CAST(CAST(l_extendedprice AS DECIMAL(14,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(14,2))) AS expenses
        FROM lineitem JOIN dim_vehicle dv ON l_orderkey = dv.vehicle_id GROUP BY 1) e ON p.vehicle_key = e.vehicle_key)""",
                                     "fact_profit", "dim_vehicle"),
    "benchmark_in_documents": sql("""
SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON length(b.text) > 0 AND contains(d.text, b.text)"""),
    "versioned_listing": sql("""
SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 2 END AS version FROM orders"""),
    "contract_violations": sql(f"""
SELECT 'repair_job_part' AS "table", 'not_null' AS rule, 'line_id' AS "column", CAST(COUNT(*) FILTER (WHERE line_id IS NULL) AS BIGINT) AS failing FROM repair_job_part
UNION ALL SELECT 'repair_job_part', 'not_null', 'part_id', COUNT(*) FILTER (WHERE part_id IS NULL) FROM repair_job_part
UNION ALL SELECT 'repair_job_part', 'unique', 'line_id', COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM repair_job_part GROUP BY line_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'repair_job_part', 'foreign_key', 'part_id', COUNT(*) FROM repair_job_part l WHERE l.part_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.part_id)
UNION ALL SELECT 'repair_job_part', 'foreign_key', 'repair_job_id', COUNT(*) FROM repair_job_part l WHERE NOT EXISTS (SELECT 1 FROM repair_job j WHERE j.repair_job_id = l.repair_job_id)
UNION ALL SELECT 'purchase', 'not_null', 'vehicle_id', COUNT(*) FILTER (WHERE vehicle_id IS NULL) FROM purchase
UNION ALL SELECT 'purchase', 'not_null', 'price_amount', COUNT(*) FILTER (WHERE price_amount IS NULL) FROM purchase
UNION ALL SELECT 'purchase', 'allowed_values', 'price_currency', COUNT(*) FILTER (WHERE price_currency NOT IN ('USD', 'NGN')) FROM purchase
UNION ALL SELECT 'purchase', 'unique', 'purchase_id', COALESCE(SUM(n), 0) FROM (SELECT COUNT(*) AS n FROM purchase GROUP BY purchase_id HAVING COUNT(*) > 1)
UNION ALL SELECT 'purchase', 'foreign_key', 'buyer_staff_id', COUNT(*) FROM purchase p WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = p.buyer_staff_id)
UNION ALL SELECT 'review_task', 'not_null', 'source_id', COUNT(*) FILTER (WHERE source_id IS NULL) FROM review_task
UNION ALL SELECT 'review_task', 'allowed_values', 'status', COUNT(*) FILTER (WHERE status NOT IN ('OPEN', 'IN_PROGRESS', 'RESOLVED', 'DISMISSED')) FROM review_task
UNION ALL SELECT 'review_task', 'polymorphic_fk', 'source_type,source_id', COUNT(*) FROM review_task t
  WHERE NOT ((t.source_type = 'EXTRACTED_EVENT' AND EXISTS (SELECT 1 FROM raw_message m WHERE m.message_id = t.source_id))
          OR (t.source_type = 'EXTRACTED_RECEIPT_LINE' AND EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = t.source_id)))""",
                               "repair_job_part", "repair_job", "purchase", "review_task", "raw_message"),
    "source_mix": sql("""
SELECT entity, source_id, COUNT(*) AS records,
       round(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY entity), 2) AS pct_of_records
FROM (SELECT 'purchase' AS entity, source_id FROM purchase UNION ALL SELECT 'sale', source_id FROM sale
      UNION ALL SELECT 'repair_job', source_id FROM repair_job) GROUP BY 1, 2""", "purchase", "sale", "repair_job"),
    "payload_fields": sql("""
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events"""),
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
