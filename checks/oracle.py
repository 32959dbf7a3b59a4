"""The same inputs and reports as SQL for DuckDB: common table expressions by name."""

from __future__ import annotations

import re

CTES: dict[str, str] = {}


def _cte(name: str, body: str) -> None:
    CTES[name] = body.strip()


_cte("fx_roster", """
SELECT * FROM (VALUES
  (1,'asha.rao1@example.com','old'), (2,'binod.kumar@example.com','old'), (3,'carla.mendes9@example.com','new'),
  (4,'dev.patel2@example.com','old'), (5,'e.farah@example.com','new'), (6,'gita.nair7@example.com','new'),
  (7,'hari.om@example.com','old'), (8,'iris.wong@example.com','new')) AS t(roster_seq, email, team)
""")
_cte("fx_override", "SELECT * FROM (VALUES ('ZED ALIAS','dev.patel2@example.com')) AS t(clean_name, email)")
_cte("fx_bdm", """
SELECT * FROM (VALUES
  (0,'Asha Rao'), (1,'RAO  ASHA.'), (2,'Binod Kumaar'), (3,'Mendes, Carla'), (4,'Zed-Alias'),
  (5,'Farah E'), (6,'Geeta Nair'), (7,'Quentin Xylophone'), (8,CAST(NULL AS VARCHAR)), (9,'12345')) AS t(bdm_no, bdm_name)
""")
_cte("fx_agent", """
SELECT n.n_nationkey, r.email AS agent_mapped
FROM nation n LEFT JOIN fx_roster r ON r.roster_seq = n.n_nationkey % 10 + 1
""")
_cte("fx_sales", """
SELECT o.o_orderkey AS row_seq, CAST(o.o_orderdate AS DATE) AS sale_date, b.bdm_name,
       CASE WHEN o.o_orderkey % 211 = 0 THEN NULL
            WHEN o.o_orderkey % 3 = 0 THEN concat('DP-', CAST(o.o_custkey AS VARCHAR))
            WHEN o.o_orderkey % 3 = 1 THEN concat(CAST(o.o_custkey AS VARCHAR), '.0')
            ELSE concat(' ', CAST(o.o_custkey AS VARCHAR), ' ') END AS dp_id,
       CASE WHEN o.o_orderkey % 50 = 0 THEN 'n/a' WHEN o.o_orderkey % 7 = 0 THEN CAST(o.o_totalprice AS VARCHAR) || '014'
            ELSE CAST(o.o_totalprice AS VARCHAR) END AS net_premium
FROM orders o JOIN fx_bdm b ON b.bdm_no = o.o_custkey % 10
""")
_cte("fx_partner", """
SELECT CAST(c_custkey AS VARCHAR) AS dpno, concat('L', CAST(c_custkey AS VARCHAR)) AS partner_id FROM customer
""")
_cte("fx_policy", """
SELECT concat('L', CAST(o_custkey AS VARCHAR)) AS login_id, concat('P', CAST(o_orderkey AS VARCHAR)) AS policy_id,
       o_orderdate AS created_at, CAST(o_totalprice AS DECIMAL(18,2)) AS net_premium,
       CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'HEALTH' ELSE 'MOTOR' END AS vertical,
       CASE o_orderstatus WHEN 'F' THEN 'NEW' WHEN 'P' THEN 'PORTABILITY' ELSE 'RENEWAL' END AS businesstype
FROM orders
""")
_cte("fx_quotes", """
SELECT concat('Q', CAST(user_id AS VARCHAR), '-', CAST(event_id % 3 AS VARCHAR)) AS quote_id,
       CAST(user_id AS VARCHAR) AS dp_id,
       CASE event_type WHEN 'purchase' THEN 'Sale-Done' WHEN 'signup' THEN 'Quote-Created'
                       WHEN 'click' THEN 'Proposal' WHEN 'view' THEN 'Follow-Up' ELSE 'Lost' END AS stage,
       CASE WHEN event_id % 97 = 0 THEN '' WHEN event_id % 89 = 0 THEN 'bad date' WHEN event_id % 83 = 0 THEN NULL
            WHEN event_id % 4 = 0 THEN concat(CAST(day(ts) AS VARCHAR), '/', CAST(month(ts) AS VARCHAR), '/', CAST(year(ts) AS VARCHAR))
            ELSE concat(' ', lpad(CAST(month(ts) AS VARCHAR), 2, '0'), '/', lpad(CAST(day(ts) AS VARCHAR), 2, '0'), '/', CAST(year(ts) AS VARCHAR), ' 10:15') END AS creation_date,
       CASE WHEN event_id % 5 = 0 THEN NULL
            ELSE concat(CAST(month(ts) AS VARCHAR), '/', CAST(day(ts) AS VARCHAR), '/', CAST(2023 + user_id % 2 AS VARCHAR)) END AS last_update_date
FROM events
""")
_cte("fx_dp_master", """
SELECT CAST(c.c_custkey AS VARCHAR) AS dp_id,
       CASE WHEN c.c_custkey % 41 = 0 THEN NULL WHEN c.c_custkey % 43 = 0 THEN '#N/A' ELSE a.agent_mapped END AS agent_mapped,
       CASE WHEN s.sqldate = '2023-11-30' THEN 'Regular'
            WHEN c.c_mktsegment IN ('BUILDING','MACHINERY') THEN 'Favourite' ELSE 'Regular' END AS dp_category,
       CASE WHEN c.c_custkey % 11 = 0 THEN 'Remap-DP' WHEN c.c_custkey % 11 = 1 THEN NULL ELSE 'Connected' END AS last_call_disposition,
       s.sqldate
FROM customer c
JOIN fx_agent a ON a.n_nationkey = c.c_nationkey
CROSS JOIN (VALUES ('2023-11-30'), ('2023-12-31')) AS s(sqldate)
""")
_cte("fx_supply", """
SELECT d.snapshot_date, a.agent_mapped, COUNT(DISTINCT o.o_custkey) AS sum_inactive_dps_creating_quotes
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS snapshot_date FROM orders
      WHERE day(o_orderdate) IN (5, 12, 19, 28)) d
JOIN orders o ON date_trunc('month', o.o_orderdate) = date_trunc('month', d.snapshot_date)
             AND CAST(o.o_orderdate AS DATE) <= d.snapshot_date
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN fx_agent a ON a.n_nationkey = c.c_nationkey
GROUP BY d.snapshot_date, a.agent_mapped
""")
_cte("fx_fav_pool", """
SELECT s.snapshot_date, a.agent_mapped, COUNT(c.c_custkey) AS dp_count
FROM (SELECT DISTINCT snapshot_date FROM fx_supply WHERE month(snapshot_date) <> 4) s
CROSS JOIN customer c JOIN fx_agent a ON a.n_nationkey = c.c_nationkey
WHERE c.c_mktsegment IN ('BUILDING','MACHINERY')
GROUP BY s.snapshot_date, a.agent_mapped
""")
_cte("fx_files", """
SELECT sale_date,
       CASE WHEN day(sale_date) % 7 = 0 THEN concat('~$Health_', CAST(sale_date AS VARCHAR), '.xlsx')
            WHEN day(sale_date) % 5 = 0 THEN concat('DP_Status_', CAST(sale_date AS VARCHAR), '.csv')
            ELSE concat('Health_', CAST(sale_date AS VARCHAR), '.xlsx') END AS file_name,
       sale_date + CAST(day(sale_date) * 37 % 11 AS INTEGER) AS arrived_at
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS sale_date FROM orders) t
""")
_cte("fx_messages", """
SELECT o_orderkey AS message_id,
       CASE o_custkey % 5 WHEN 0 THEN 'Lead <LEAD@example.com>' WHEN 1 THEN 'reports@example.com'
                          WHEN 2 THEN NULL ELSE 'other@example.com' END AS sender,
       concat(monthname(o_orderdate), CASE WHEN o_orderkey % 2 = 0 THEN ' Sale''s file' ELSE ' premium data' END) AS subject,
       o_orderdate AS received_at,
       CASE o_orderkey % 3 WHEN 0 THEN 'Health.XLSX' WHEN 1 THEN NULL ELSE 'sales.xls' END AS workbook
FROM orders
""")
_cte("fx_wide_names", """
SELECT c_custkey, concat(translate(CAST(c_custkey * 7919 AS VARCHAR), '0123456789', 'aeinorstlm'),
       CASE c_custkey % 3 WHEN 0 THEN ' Asha' WHEN 1 THEN ' Binod' ELSE ' Carla' END) AS bdm_name FROM customer
""")
_cte("fx_wide_roster", """
SELECT CAST(s_suppkey AS INTEGER) AS roster_seq,
       concat(CASE s_suppkey % 3 WHEN 0 THEN 'binod.' WHEN 1 THEN 'asha.' ELSE 'c' END,
              translate(CAST(s_suppkey * 104729 AS VARCHAR), '0123456789', 'aeinorstlm'), CAST(s_suppkey AS VARCHAR), '@example.com') AS email,
       CASE WHEN s_suppkey % 2 = 0 THEN 'old' ELSE 'new' END AS team
FROM supplier
""")

# --- cleaned and enriched sales -------------------------------------------------------
_cte("sales_clean", r"""
SELECT row_seq, sale_date, bdm_name, net_premium,
       trim(regexp_replace(trim(split_part(dp_id, '-', -1)), '\.0$', '')) AS dp_id
FROM fx_sales
""")
_cte("sales_unique", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY dp_id ORDER BY row_seq) AS rn FROM sales_clean) t WHERE rn = 1
""")
_cte("policy_filtered", """
SELECT p.*, c.dpno FROM fx_policy p
JOIN (SELECT dpno, partner_id FROM fx_partner WHERE dpno IN (SELECT dp_id FROM sales_unique WHERE dp_id IS NOT NULL)) c
  ON c.partner_id = p.login_id
WHERE p.vertical = 'HEALTH' AND p.businesstype IN ('NEW','PORTABILITY')
""")
_cte("status_flag", """
SELECT login_id, MIN(created_at) AS first_sale_date,
       CASE WHEN MIN(created_at) < TIMESTAMP '1996-08-01' THEN 'Already Active'
            WHEN MIN(created_at) < TIMESTAMP '1998-06-01' THEN 'Activated by LGLC' ELSE 'Inactive' END AS client_status
FROM policy_filtered GROUP BY login_id
""")
_cte("dp_status", """
SELECT p.dpno, p.login_id, COUNT(DISTINCT p.policy_id) AS policy_count, SUM(p.net_premium) AS total_netpremium, s.client_status
FROM policy_filtered p JOIN status_flag s ON s.login_id = p.login_id
WHERE p.created_at >= TIMESTAMP '1996-01-01'
GROUP BY p.dpno, p.login_id, s.client_status
""")
_cte("status_lookup", """
SELECT dpno, CASE MAX(CASE client_status WHEN 'Already Active' THEN 3 WHEN 'Activated by LGLC' THEN 2 ELSE 1 END)
             WHEN 3 THEN 'Already Active' WHEN 2 THEN 'Activated by LGLC' ELSE 'Inactive' END AS client_status
FROM dp_status GROUP BY dpno
""")
_cte("sales_enriched", """
SELECT s.*, coalesce(l.client_status, 'Inactive') AS dp_status
FROM sales_clean s LEFT JOIN status_lookup l ON l.dpno = s.dp_id
""")
_cte("unique_enriched", """
SELECT s.*, coalesce(l.client_status, 'Inactive') AS dp_status
FROM sales_unique s LEFT JOIN status_lookup l ON l.dpno = s.dp_id
""")
_cte("named_sales", """
SELECT *, trim(regexp_replace(upper(coalesce(bdm_name, '')), '[^A-Z]+', ' ', 'g')) AS clean_name FROM sales_enriched
""")


# --- name matching ---------------------------------------------------------------------
def _fuzzy(prefix: str, names: str, roster: str, override: str) -> None:
    """CTEs <prefix>_pairs .. <prefix>_map; the LCS runs as a recursion over the letters of a name."""
    _cte(f"{prefix}_names", f"""
SELECT clean_name, coalesce(array_to_string(list_sort(string_split(clean_name, ' ')), ' '), '') AS a FROM (
  SELECT DISTINCT trim(regexp_replace(upper(coalesce(bdm_name, '')), '[^A-Z]+', ' ', 'g')) AS clean_name FROM {names}) t
""")
    _cte(f"{prefix}_locals", f"""
SELECT roster_seq, email, local, array_to_string(list_sort(string_split(local, ' ')), ' ') AS b FROM (
  SELECT roster_seq, email, trim(regexp_replace(upper(split_part(email, '@', 1)), '[^A-Z]+', ' ', 'g')) AS local FROM {roster}) t
""")
    _cte(f"{prefix}_masks", f"""
SELECT roster_seq, substring(b, CAST(i AS INTEGER), 1) AS ch, SUM(CAST(1 AS HUGEINT) << CAST(i - 1 AS INTEGER)) AS m
FROM (SELECT roster_seq, b, unnest(range(1, length(b) + 1)) AS i FROM {prefix}_locals) t GROUP BY 1, 2
""")
    _cte(f"{prefix}_steps", f"""
SELECT n.clean_name, n.a, r.roster_seq, r.email, r.local, r.b, 0 AS i, (CAST(1 AS HUGEINT) << length(r.b)) - 1 AS s
FROM {prefix}_names n CROSS JOIN {prefix}_locals r
UNION ALL
SELECT t.clean_name, t.a, t.roster_seq, t.email, t.local, t.b, t.i + 1,
       (((t.s + (t.s & coalesce(k.m, 0)::HUGEINT)) | (t.s - (t.s & coalesce(k.m, 0)::HUGEINT))) & ((CAST(1 AS HUGEINT) << length(t.b)) - 1))
FROM {prefix}_steps t LEFT JOIN {prefix}_masks k ON k.roster_seq = t.roster_seq AND k.ch = substring(t.a, t.i + 1, 1)
WHERE t.i < length(t.a)
""")
    _cte(f"{prefix}_scores", f"""
SELECT clean_name, roster_seq, email,
       CASE WHEN length(a) > 0 AND length(b) > 0
            THEN CAST(round_even(200.0::DOUBLE * (length(b) - bit_count(s)) / (length(a) + length(b)), 0) AS INTEGER) ELSE 0 END
       + CASE WHEN clean_name <> '' AND local <> '' AND substring(clean_name, 1, 1) = substring(local, 1, 1) THEN 5 ELSE 0 END AS score
FROM {prefix}_steps WHERE i = length(a)
""")
    _cte(f"{prefix}_map", f"""
SELECT b.clean_name, coalesce(o.email, CASE WHEN b.score > 55 THEN b.email ELSE 'Unmapped' END) AS email, b.score AS best_score
FROM (SELECT *, row_number() OVER (PARTITION BY clean_name ORDER BY score DESC, roster_seq) AS rn FROM {prefix}_scores) b
LEFT JOIN {override} o ON o.clean_name = b.clean_name WHERE b.rn = 1
""")


_fuzzy("fuzzy", "fx_sales", "fx_roster", "fx_override")
_fuzzy("wide", "fx_wide_names", "fx_wide_roster", "fx_override")

# --- metrics -----------------------------------------------------------------------------
_cte("numerators", """
SELECT m.email, COUNT(*) FILTER (WHERE dp_status = 'Inactive') AS act_num,
       COUNT(*) FILTER (WHERE dp_status IN ('Activated by LGLC','Already Active')) AS fav_num, COUNT(dp_status) AS con_num
FROM (SELECT *, trim(regexp_replace(upper(coalesce(bdm_name, '')), '[^A-Z]+', ' ', 'g')) AS clean_name FROM unique_enriched) u
JOIN fuzzy_map m ON m.clean_name = u.clean_name GROUP BY m.email
""")
_cte("day_supply", "SELECT agent_mapped, sum_inactive_dps_creating_quotes FROM fx_supply WHERE snapshot_date = DATE '1998-06-12'")
_cte("day_pool", "SELECT agent_mapped, dp_count FROM fx_fav_pool WHERE snapshot_date = DATE '1998-06-12'")
_cte("act_dens", """
SELECT agent_mapped, SUM(sum_inactive_dps_creating_quotes) AS act_den FROM day_supply WHERE agent_mapped IS NOT NULL GROUP BY 1
""")
_cte("fav_dens", "SELECT agent_mapped, SUM(dp_count) AS fav_den FROM day_pool WHERE agent_mapped IS NOT NULL GROUP BY 1")
_cte("outer_nd", """
SELECT coalesce(n.email, a.agent_mapped, f.agent_mapped) AS email, coalesce(act_num, 0) AS act_num, coalesce(fav_num, 0) AS fav_num,
       coalesce(con_num, 0) AS con_num, coalesce(act_den, 0) AS act_den, coalesce(fav_den, 0) AS fav_den
FROM numerators n FULL JOIN act_dens a ON a.agent_mapped = n.email
FULL JOIN fav_dens f ON f.agent_mapped = coalesce(n.email, a.agent_mapped)
""")
_cte("email_counts", """
SELECT o.email, act_num, fav_num, con_num, act_den, fav_den, act_den + fav_den AS con_den, coalesce(r.team, 'unknown') AS team
FROM outer_nd o LEFT JOIN fx_roster r ON r.email = o.email
""")
_cte("team_counts", """
SELECT team, SUM(act_num) AS act_num, SUM(fav_num) AS fav_num, SUM(con_num) AS con_num, SUM(act_den) AS act_den,
       SUM(fav_den) AS fav_den, SUM(con_den) AS con_den FROM email_counts GROUP BY team
""")
_cte("overall", """
SELECT *, act_den + fav_den AS con_den FROM (
  SELECT (SELECT COUNT(*) FROM unique_enriched WHERE dp_status = 'Inactive') AS act_num,
         (SELECT COUNT(*) FROM unique_enriched WHERE dp_status IN ('Activated by LGLC','Already Active')) AS fav_num,
         (SELECT COUNT(dp_status) FROM unique_enriched) AS con_num,
         (SELECT coalesce(SUM(sum_inactive_dps_creating_quotes), 0) FROM day_supply) AS act_den,
         (SELECT coalesce(SUM(dp_count), 0) FROM day_pool) AS fav_den) t
""")
_cte("premium", """
SELECT SUM(p) FILTER (WHERE dp_status = 'Inactive') AS inactive_premium, COUNT(*) FILTER (WHERE dp_status = 'Inactive') AS inactive_nop,
       COUNT(DISTINCT dp_id) FILTER (WHERE dp_status = 'Inactive') AS inactive_dps,
       SUM(p) FILTER (WHERE dp_status <> 'Inactive') AS fav_premium, COUNT(*) FILTER (WHERE dp_status <> 'Inactive') AS fav_nop,
       COUNT(DISTINCT dp_id) FILTER (WHERE dp_status <> 'Inactive') AS fav_dps
FROM (SELECT *, coalesce(TRY_CAST(trim(net_premium) AS DECIMAL(38,10)), 0) AS p FROM sales_enriched) t
""")
_cte("premium_rates", """
SELECT CAST(inactive_premium AS DOUBLE) AS inactive_premium, inactive_nop, CAST(fav_premium AS DOUBLE) AS fav_premium, fav_nop, inactive_dps, fav_dps,
       CAST(inactive_premium AS DOUBLE) / inactive_nop AS avg_premium_inactive, CAST(fav_premium AS DOUBLE) / fav_nop AS avg_premium_fav,
       CAST(inactive_nop AS DOUBLE) / inactive_dps AS nop_per_dp_inactive, CAST(fav_nop AS DOUBLE) / fav_dps AS nop_per_dp_fav
FROM premium
""")


# --- supply from quotes ---------------------------------------------------------------------
def _mixed(column: str) -> str:
    word = f"split_part(trim({column}), ' ', 1)"
    return f"CAST(coalesce(try_strptime({word}, '%m/%d/%Y'), try_strptime({word}, '%d/%m/%Y')) AS DATE)"


MIXED_CREATION, MIXED_UPDATE = _mixed("creation_date"), _mixed("last_update_date")

_cte("month_quotes", f"""
SELECT * FROM (SELECT quote_id, dp_id, stage, {MIXED_CREATION} AS creation_day FROM fx_quotes
               WHERE creation_date IS NOT NULL AND trim(creation_date) <> '') t
WHERE creation_day BETWEEN DATE '2024-01-01' AND DATE '2024-01-31'
""")
_cte("stage_quotes", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY quote_id, creation_day ORDER BY stage DESC NULLS LAST, dp_id NULLS LAST) AS rn
                            FROM month_quotes) t WHERE rn = 1
""")
_cte("dp_month", """
SELECT dp_id, CAST(date_trunc('month', creation_day) AS DATE) AS quote_month, COUNT(*) AS quotes_count FROM stage_quotes GROUP BY 1, 2
""")
_cte("dp_latest", """
SELECT * EXCLUDE (rn) FROM (
  SELECT dp_id, agent_mapped, dp_category, sqldate,
         row_number() OVER (PARTITION BY dp_id ORDER BY sqldate DESC, agent_mapped NULLS LAST, dp_category NULLS LAST) AS rn
  FROM fx_dp_master WHERE agent_mapped IS NOT NULL) t WHERE rn = 1
""")
_cte("first_done", f"""
SELECT dp_id, MIN(done_on) AS first_sale_done FROM (SELECT dp_id, {MIXED_UPDATE} AS done_on FROM fx_quotes WHERE stage = 'Sale-Done') t
WHERE done_on IS NOT NULL GROUP BY dp_id
""")
_cte("dp_details", """
SELECT q.dp_id, q.quote_month, q.quotes_count, d.agent_mapped, d.dp_category, f.first_sale_done
FROM dp_month q LEFT JOIN dp_latest d ON d.dp_id = q.dp_id LEFT JOIN first_done f ON f.dp_id = q.dp_id
""")
_cte("agent_quotes", """
SELECT dp_id, agent_mapped, quote_month, quotes_count,
       CASE WHEN dp_category = 'Favourite' AND CAST(date_trunc('month', first_sale_done) AS DATE) = quote_month THEN 'Inactive'
            WHEN dp_category = 'Favourite' THEN 'Favourite' ELSE 'Inactive' END AS category_type FROM dp_details
""")
_cte("agent_supply", """
SELECT agent_mapped, quote_month, COUNT(DISTINCT dp_id) AS inactive_dps_creating_quotes FROM agent_quotes
WHERE agent_mapped IS NOT NULL AND category_type = 'Inactive' GROUP BY agent_mapped, quote_month
""")
_cte("fav_rows", """
SELECT * FROM fx_dp_master WHERE dp_category = 'Favourite' AND last_call_disposition NOT IN ('Remap-DP') AND sqldate = '2023-12-31'
""")

# --- collation -------------------------------------------------------------------------------
_cte("daily_all", r"""
SELECT n.row_seq, n.sale_date, n.bdm_name, n.dp_id, TRY_CAST(trim(n.net_premium) AS DECIMAL(38,10)) AS net_premium, n.dp_status,
       coalesce(r.team, 'unknown') AS team
FROM named_sales n LEFT JOIN fuzzy_map m ON m.clean_name = n.clean_name LEFT JOIN fx_roster r ON r.email = m.email
""")
_cte("collate_rows", """
SELECT 1 AS batch_seq, * FROM daily_all WHERE sale_date <= DATE '1998-06-15'
UNION ALL -- a premium that differs in its third digit only is another sale
SELECT 1, * REPLACE (net_premium + CAST(0.001 AS DECIMAL(38,10)) AS net_premium) FROM daily_all WHERE sale_date <= DATE '1998-06-15' AND row_seq % 11 = 0
UNION ALL
SELECT 2, * REPLACE ('Activated by LGLC' AS dp_status) FROM daily_all WHERE sale_date >= DATE '1998-06-08'
""")
_cte("master", """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY dp_id, sale_date, net_premium ORDER BY batch_seq DESC, row_seq DESC) AS rn FROM collate_rows) t
WHERE rn = 1
""")

# --- rates ----------------------------------------------------------------------------------
_cte("rate_master", "SELECT row_seq, sale_date, dp_id, dp_status FROM sales_enriched")
_cte("totals", "SELECT snapshot_date, SUM(sum_inactive_dps_creating_quotes) AS mtd FROM fx_supply GROUP BY snapshot_date")
_cte("deltas", """
SELECT snapshot_date,
       coalesce(lag(snapshot_date) OVER w + 1, CAST(date_trunc('month', snapshot_date) AS DATE)) AS period_start,
       mtd - lag(mtd, 1, 0) OVER w AS act_den
FROM totals WINDOW w AS (PARTITION BY date_trunc('month', snapshot_date) ORDER BY snapshot_date)
""")
_cte("pools", """
SELECT month_first, fav_den FROM (
  SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month_first, fav_den,
         row_number() OVER (PARTITION BY date_trunc('month', snapshot_date) ORDER BY snapshot_date) AS rn
  FROM (SELECT snapshot_date, SUM(dp_count) AS fav_den FROM fx_fav_pool GROUP BY snapshot_date) t) t2 WHERE rn = 1
""")
_cte("period_counts", """
SELECT d.snapshot_date, COUNT(DISTINCT s.dp_id) FILTER (WHERE trim(s.dp_status) = 'Inactive') AS act_num,
       COUNT(DISTINCT s.dp_id) FILTER (WHERE trim(s.dp_status) IN ('Activated by LGLC','Already Active')) AS fav_num,
       COUNT(DISTINCT s.dp_id) AS con_num
FROM deltas d JOIN rate_master s ON s.sale_date BETWEEN d.period_start AND d.snapshot_date GROUP BY d.snapshot_date
""")
_cte("week_counts", """
SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week_start, COUNT(DISTINCT dp_id) FILTER (WHERE trim(dp_status) = 'Inactive') AS act_num,
       COUNT(DISTINCT dp_id) FILTER (WHERE trim(dp_status) IN ('Activated by LGLC','Already Active')) AS fav_num,
       COUNT(DISTINCT dp_id) AS con_num
FROM rate_master WHERE sale_date IS NOT NULL GROUP BY 1
""")
_cte("week_supply", """
SELECT w.week_start,
       coalesce((SELECT max_by(t.mtd, t.snapshot_date) FROM totals t WHERE t.snapshot_date <= w.week_start + 6
                 AND date_trunc('month', t.snapshot_date) = date_trunc('month', w.week_start + 6)), 0) AS mtd_end,
       coalesce((SELECT max_by(t.mtd, t.snapshot_date) FROM totals t WHERE t.snapshot_date <= w.week_start - 1
                 AND date_trunc('month', t.snapshot_date) = date_trunc('month', w.week_start - 1)), 0) AS mtd_before
FROM week_counts w
""")


# --- rates of a kept master ----------------------------------------------------------------------
for _kept, _counts in (("kept_period_counts", "period_counts"), ("kept_week_counts", "week_counts")):
    _cte(_kept, CTES[_counts].replace("rate_master", "master"))
_cte("kept_week_supply", CTES["week_supply"].replace("week_counts", "kept_week_counts"))

# --- a run after another -----------------------------------------------------------------------------
_cte("run_sales", """
SELECT *, CASE WHEN sale_date < DATE '1998-06-01' THEN 1 ELSE 2 END AS run_no, TRY_CAST(trim(net_premium) AS DECIMAL(38,10)) AS p
FROM sales_clean WHERE sale_date BETWEEN DATE '1998-05-01' AND DATE '1998-06-15'
""")
_cte("run_master", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY dp_id, sale_date, p ORDER BY row_seq DESC) AS rn FROM run_sales) t WHERE rn = 1
""")
_cte("run_unique", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY run_no, dp_id ORDER BY row_seq) AS rn FROM run_sales) t WHERE rn = 1
""")
_cte("run_status", "SELECT DISTINCT s.run_no, d.* FROM run_sales s JOIN dp_status d ON d.dpno = s.dp_id")
_cte("stream_rows", """
SELECT 1 AS delivery, row_seq, sale_date, dp_id, dp_status FROM sales_enriched WHERE sale_date <= DATE '1998-06-15'
UNION ALL SELECT 2, row_seq, sale_date, dp_id, 'Activated by LGLC' FROM sales_enriched WHERE sale_date >= DATE '1998-06-08'
""")
_cte("stream_unique", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY delivery, dp_id ORDER BY row_seq) AS rn FROM stream_rows) t WHERE rn = 1
""")
_cte("stream_days", """
SELECT delivery, data_date, coalesce((SELECT MAX(snapshot_date) FROM fx_supply WHERE snapshot_date = data_date), (SELECT MAX(snapshot_date) FROM fx_supply)) AS supply_day,
       coalesce((SELECT MAX(snapshot_date) FROM fx_fav_pool WHERE snapshot_date = data_date), (SELECT MAX(snapshot_date) FROM fx_fav_pool)) AS pool_day
FROM (SELECT delivery, MAX(sale_date) AS data_date FROM stream_rows GROUP BY delivery) t
""")

_NAMES = re.compile(r"\b[a-z_]+\b")


def _needed(text: str, found: set[str]) -> None:
    for word in set(_NAMES.findall(text)) & CTES.keys():
        if word not in found:
            found.add(word)
            _needed(CTES[word], found)


def statement(body: str, dates: tuple[str, ...] = (), doubles: tuple[str, ...] = (), rates: tuple[str, ...] = ()) -> str:
    """A whole statement: the CTEs the body needs, then the body.

    As in the registered queries, dates leave as text, money as double, rates with six digits.
    """
    found: set[str] = set()
    _needed(body, found)
    ctes = [f"{name} AS ({CTES[name]})" for name in CTES if name in found]
    replaced = [f"CAST({c} AS VARCHAR) AS {c}" for c in dates]
    replaced += [f"CAST({c} AS DOUBLE) AS {c}" for c in doubles]
    replaced += [f"round({c}, 6) AS {c}" for c in rates]
    head = f"WITH RECURSIVE {', '.join(ctes)} " if ctes else ""
    star = f"* REPLACE ({', '.join(replaced)})" if replaced else "*"
    return f"{head}SELECT {star} FROM ({body}) AS result"


def with_rates(source: str) -> str:
    """The body that adds the three rates to a table of numerators and denominators."""
    parts = [("act", "activation_rate"), ("fav", "favourite_rate"), ("con", "consolidated_rate")]
    columns = ", ".join(
        f"CASE WHEN {p}_den > 0 THEN CAST({p}_num AS DOUBLE) / CAST({p}_den AS DOUBLE) ELSE 0.0 END AS {name}" for p, name in parts
    )
    return f"SELECT *, {columns} FROM {source}"


RATES = ("activation_rate", "favourite_rate", "consolidated_rate")
