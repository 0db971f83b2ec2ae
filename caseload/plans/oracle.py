"""Independent DuckDB SQL for the oracle check.

Each query's SQL is ``WITH <needed CTEs> <final select>``; CTEs are declared once here with
their dependencies and resolved in order. The SQL is written from the operator definitions,
not generated from the Spark plans.
"""

from __future__ import annotations

from caseload.config import DEFAULT_CALENDAR as CAL
from caseload.sources.contracts import PEER_INPUT_COLUMNS

D = CAL.sql_date
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def cte(name: str, deps: tuple[str, ...] = ()):
    def register(sql: str):
        CTES[name] = (sql, deps)
        return sql
    return register


def with_ctes(final_sql: str, *names: str) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS MATERIALIZED (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final_sql}"


# --------------------------------------------------------------------------- panel
cte("orders_m")(f"""
  SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS order_date,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS transaction_month
  FROM orders
  WHERE o_custkey IS NOT NULL AND o_orderdate IS NOT NULL""")
cte("order_month", ("orders_m",))("""
  SELECT o_custkey, transaction_month, count(*) AS order_count,
         count(DISTINCT order_date) AS active_order_days
  FROM orders_m GROUP BY o_custkey, transaction_month""")
cte("per_part", ("orders_m",))("""
  SELECT o.o_custkey, o.transaction_month, l.l_partkey, max(p.p_type) AS p_type,
         count(*) AS lines, sum(l.l_extendedprice) AS gross,
         sum(l.l_extendedprice * l.l_discount) AS discount_amount,
         sum(l.l_extendedprice * (1.0 - l.l_discount)) AS net,
         sum(l.l_quantity) AS quantity,
         sum(CASE WHEN p.p_type = 'PROMO' THEN 1 ELSE 0 END) AS promo_lines,
         sum(CASE WHEN l.l_returnflag = 'R' AND l.l_linestatus = 'F' THEN 1 ELSE 0 END) AS return_lines
  FROM lineitem l JOIN orders_m o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY o.o_custkey, o.transaction_month, l.l_partkey""")
cte("line_month", ("per_part",))("""
  SELECT o_custkey, transaction_month, sum(lines) AS line_count,
         count(l_partkey) AS distinct_product_count, sum(gross) AS gross_revenue,
         sum(discount_amount) AS discount_amount, sum(net) AS net_revenue,
         sum(quantity) AS quantity, sum(promo_lines) AS promo_lines,
         sum(return_lines) AS return_lines, max(net) AS top_part_net
  FROM per_part GROUP BY o_custkey, transaction_month""")
cte("mix_shift", ("per_part", "line_month"))("""
  SELECT o_custkey, transaction_month,
         0.5 * (sum(abs(a - b)) + 1.0 - sum(b)) AS category_mix_shift
  FROM (
    SELECT t.o_custkey, t.transaction_month,
           t.type_lines / m.line_count AS a, t.prior_type_lines / m.prior_lines AS b,
           m.prior_lines
    FROM (
      SELECT o_custkey, transaction_month, type_lines,
             coalesce(sum(type_lines) OVER (PARTITION BY o_custkey, p_type ORDER BY transaction_month
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior_type_lines
      FROM (SELECT o_custkey, transaction_month, p_type, sum(lines) AS type_lines
            FROM per_part GROUP BY o_custkey, transaction_month, p_type) x
    ) t JOIN (
      SELECT o_custkey, transaction_month, line_count,
             sum(line_count) OVER (PARTITION BY o_custkey ORDER BY transaction_month
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_lines
      FROM line_month
    ) m USING (o_custkey, transaction_month)
  ) z WHERE prior_lines > 0
  GROUP BY o_custkey, transaction_month""")
cte("spine", ("order_month",))(f"""
  SELECT o_custkey, first_observed_month, CAST(m AS DATE) AS transaction_month
  FROM (SELECT o_custkey, first_observed_month,
               unnest(generate_series(CAST(first_observed_month AS TIMESTAMP),
                                      CAST(panel_end AS TIMESTAMP), INTERVAL 1 MONTH)) AS m
        FROM (SELECT o_custkey, min(transaction_month) AS first_observed_month
              FROM order_month GROUP BY o_custkey) f
        CROSS JOIN (SELECT max(transaction_month) AS panel_end FROM order_month) e) s""")
cte("facts", ("spine", "order_month", "line_month", "mix_shift"))("""
  SELECT CAST(s.o_custkey AS VARCHAR) AS customer_public_id, s.o_custkey, s.transaction_month,
         s.first_observed_month,
         CAST(coalesce(om.order_count, 0) AS BIGINT) AS order_count,
         CAST(coalesce(om.active_order_days, 0) AS BIGINT) AS active_order_days,
         CAST(coalesce(lm.distinct_product_count, 0) AS BIGINT) AS distinct_product_count,
         CASE WHEN lm.gross_revenue > 0 THEN lm.discount_amount / lm.gross_revenue END AS discount_rate,
         CASE WHEN lm.line_count > 0 THEN CAST(lm.promo_lines AS DOUBLE) / lm.line_count END AS promo_line_share,
         CASE WHEN lm.line_count > 0 THEN CAST(lm.return_lines AS DOUBLE) / lm.line_count END AS return_line_rate,
         CASE WHEN lm.net_revenue > 0 THEN lm.top_part_net / lm.net_revenue END AS top_product_revenue_share,
         coalesce(lm.net_revenue, 0.0) AS net_revenue,
         coalesce(lm.quantity, 0.0) AS quantity,
         CASE WHEN om.order_count > 0 THEN ms.category_mix_shift END AS category_mix_shift
  FROM spine s
  LEFT JOIN order_month om ON s.o_custkey = om.o_custkey AND s.transaction_month = om.transaction_month
  LEFT JOIN line_month lm ON s.o_custkey = lm.o_custkey AND s.transaction_month = lm.transaction_month
  LEFT JOIN mix_shift ms ON s.o_custkey = ms.o_custkey AND s.transaction_month = ms.transaction_month""")

# --------------------------------------------------------------------------- cadence
_W = "PARTITION BY customer_public_id ORDER BY transaction_month"
cte("cad_base", ("facts",))(f"""
  SELECT *,
         (year(transaction_month) * 12 + month(transaction_month)) AS mn,
         row_number() OVER ({_W}) AS rn
  FROM (
    SELECT customer_public_id, transaction_month, first_observed_month,
           CAST(coalesce(order_count > 0, false) AS INTEGER) AS current_has_order,
           CAST(order_count AS DOUBLE) AS current_order_count,
           coalesce(CAST(active_order_days AS DOUBLE), 0.0) AS current_active_order_days,
           coalesce(CAST(distinct_product_count AS DOUBLE), 0.0) AS current_distinct_product_count,
           coalesce(discount_rate, 0.0) AS current_discount_rate,
           coalesce(promo_line_share, 0.0) AS current_promo_line_share,
           coalesce(return_line_rate, 0.0) AS current_return_line_rate,
           coalesce(top_product_revenue_share, 0.0) AS current_top_product_share
    FROM facts) b""")
cte("cadence_all", ("cad_base",))(f"""
  SELECT *,
    avg(current_has_order) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS active_rate_3m,
    avg(current_has_order) OVER ({_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS active_rate_6m,
    avg(current_has_order) OVER ({_W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS active_rate_12m,
    avg(current_order_count) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS order_count_mean_3m,
    avg(current_order_count) OVER ({_W} ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS order_count_mean_6m,
    avg(current_order_count) OVER ({_W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS order_count_mean_12m,
    stddev_samp(current_order_count) OVER ({_W} ROWS BETWEEN 11 PRECEDING AND CURRENT ROW) AS order_count_sd_12m,
    least(999.0, greatest(0.0, coalesce(CAST(mn - max(CASE WHEN current_has_order = 1 THEN mn END)
          OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE), 999.0))) AS months_since_active,
    CASE WHEN current_has_order = 1 THEN 0.0 ELSE CAST(rn - coalesce(max(CASE WHEN current_has_order = 1 THEN rn END)
          OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS DOUBLE) END AS inactive_streak,
    CAST(lag(current_has_order, 12) OVER ({_W}) IS NOT NULL AS INTEGER) AS same_month_last_year_available,
    CAST(coalesce(lag(current_has_order, 12) OVER ({_W}), 0) AS INTEGER) AS same_month_last_year_active,
    CAST(greatest(mn - (year(first_observed_month) * 12 + month(first_observed_month)), 0) AS DOUBLE) AS tenure_months_asof,
    sin(2.0 * pi() * month(transaction_month) / 12.0) AS calendar_month_sin,
    cos(2.0 * pi() * month(transaction_month) / 12.0) AS calendar_month_cos,
    lead(transaction_month, 1) OVER ({_W}) AS target_month,
    CAST(lead(current_has_order, 1) OVER ({_W}) AS INTEGER) AS next_has_order,
    lead(current_order_count, 1) OVER ({_W}) AS next_order_count,
    lead(current_distinct_product_count, 1) OVER ({_W}) AS next_distinct_product_count,
    lead(current_discount_rate, 1) OVER ({_W}) AS next_discount_rate,
    lead(current_return_line_rate, 1) OVER ({_W}) AS next_return_line_rate
  FROM cad_base""")
cte("cadence", ("cadence_all",))(f"""
  SELECT *,
    CASE WHEN target_month <= {D('train_end')} THEN 'train'
         WHEN target_month BETWEEN {D('calib_start')} AND {D('calib_end')} THEN 'calibration'
         WHEN target_month BETWEEN {D('forward_start')} AND {D('forward_end')} THEN 'forward'
         ELSE 'unused' END AS data_split
  FROM cadence_all
  WHERE target_month = CAST(transaction_month + INTERVAL 1 MONTH AS DATE)""")

# --------------------------------------------------------------------------- scored panel
cte("peers")("""
  SELECT c.c_custkey AS o_custkey, c.c_mktsegment AS channel_peer,
         substr(sha256(concat_ws('|', CAST(c.c_nationkey AS VARCHAR), c.c_mktsegment)), 1, 12) AS company_division_peer_public_id,
         count(*) OVER (PARTITION BY substr(sha256(concat_ws('|', CAST(c.c_nationkey AS VARCHAR), c.c_mktsegment)), 1, 12))
           AS company_division_peer_customer_count
  FROM customer c""")
_HZ = ("net_revenue", "order_count", "quantity", "discount_rate", "return_rate", "category_mix_shift")
_PRIOR = f"OVER ({_W} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"


def _hz(m: str) -> str:
    src = {"return_rate": "return_line_rate"}.get(m, m)
    x = f"CAST({src} AS DOUBLE)"
    return (f"CASE WHEN stddev_samp({x}) {_PRIOR} > 1e-9 THEN ({x} - avg({x}) {_PRIOR}) / "
            f"stddev_samp({x}) {_PRIOR} END AS {m}_vs_history_z")


cte("scored_base", ("facts", "peers"))(f"""
  SELECT f.*, p.channel_peer, p.company_division_peer_public_id, p.company_division_peer_customer_count,
         {", ".join(_hz(m) for m in _HZ)},
         row_number() OVER ({_W}) - 1 AS prior_rows,
         CASE WHEN lag(CAST(net_revenue AS DOUBLE), 12) OVER ({_W}) > 0
              THEN CAST(net_revenue AS DOUBLE) / lag(CAST(net_revenue AS DOUBLE), 12) OVER ({_W}) END AS net_revenue_yoy_ratio,
         CASE WHEN lag(CAST(order_count AS DOUBLE), 12) OVER ({_W}) > 0
              THEN CAST(order_count AS DOUBLE) / lag(CAST(order_count AS DOUBLE), 12) OVER ({_W}) END AS order_count_yoy_ratio,
         ln(1 + net_revenue) AS rev_l,
         ln(1 + CASE WHEN order_count > 0 THEN net_revenue / order_count ELSE 0.0 END) AS ov_l
  FROM facts f LEFT JOIN peers p USING (o_custkey)""")
cte("scored", ("scored_base",))("""
  SELECT b.customer_public_id, b.transaction_month,
         b.prior_rows < 6 AS sparse_history_flag,
         ch.n < 5 AS sparse_peer_group_flag,
         cd.n < 5 AS sparse_company_division_peer_group_flag,
         b.company_division_peer_public_id,
         CAST(b.company_division_peer_customer_count AS BIGINT) AS company_division_peer_customer_count,
         b.order_count = 0 AS zero_order_month_flag,
         b.net_revenue_vs_history_z, b.order_count_vs_history_z, b.quantity_vs_history_z,
         b.discount_rate_vs_history_z, b.return_rate_vs_history_z, b.category_mix_shift_vs_history_z,
         CASE WHEN ch.sd > 1e-9 THEN (b.rev_l - ch.mean) / ch.sd END AS net_revenue_vs_peer_z,
         CASE WHEN cd.sd > 1e-9 THEN (b.ov_l - cd.mean) / cd.sd END AS order_value_vs_company_division_peer_z,
         b.net_revenue_vs_history_z - ch.med_rev AS net_revenue_vs_peers_resid,
         b.order_count_vs_history_z - ch.med_oc AS order_count_vs_peers_resid,
         b.net_revenue_yoy_ratio, b.order_count_yoy_ratio,
         greatest(abs(b.net_revenue_vs_history_z), abs(b.order_count_vs_history_z), abs(b.quantity_vs_history_z),
                  abs(b.discount_rate_vs_history_z), abs(b.return_rate_vs_history_z),
                  abs(b.category_mix_shift_vs_history_z)) AS baseline_anomaly_score
  FROM scored_base b
  LEFT JOIN (SELECT transaction_month, channel_peer, avg(rev_l) AS mean, stddev_samp(rev_l) AS sd, count(*) AS n,
                    median(net_revenue_vs_history_z) AS med_rev, median(order_count_vs_history_z) AS med_oc
             FROM scored_base GROUP BY transaction_month, channel_peer) ch
    ON b.transaction_month = ch.transaction_month AND b.channel_peer IS NOT DISTINCT FROM ch.channel_peer
  LEFT JOIN (SELECT transaction_month, company_division_peer_public_id, avg(ov_l) AS mean,
                    stddev_samp(ov_l) AS sd, count(*) AS n
             FROM scored_base GROUP BY transaction_month, company_division_peer_public_id) cd
    ON b.transaction_month = cd.transaction_month
   AND b.company_division_peer_public_id IS NOT DISTINCT FROM cd.company_division_peer_public_id""")


# --------------------------------------------------------------------------- S2 frame
def s2_ctes(min_peer_rows: int, bonus: float = 0.75, multiplier: float = 0.75):
    """Register (once) the S2 CTE chain for a given peer-row threshold; returns the final CTE name."""
    tag = f"s2_{min_peer_rows}"
    if f"{tag}_scores" in CTES:
        return f"{tag}_scores"
    cte(f"{tag}_masks", ("scored",))(f"""
  SELECT s.*,
         transaction_month <= {D('train_end')} AND NOT coalesce(sparse_history_flag, true) AS fit_mask,
         transaction_month BETWEEN {D('forward_start')} AND {D('forward_end')} AS forward,
         NOT coalesce(sparse_history_flag, true) AS eligible
  FROM scored s""")
    cte(f"{tag}_resid", (f"{tag}_masks",))(f"""
  SELECT m.*,
         CASE WHEN m.net_revenue_vs_history_z - c.med_s IS NULL THEN NULL
              ELSE least(greatest(m.net_revenue_vs_history_z - c.med_s, -10.0), 10.0) END AS cd_spend_residual,
         CASE WHEN m.order_count_vs_history_z - c.med_o IS NULL THEN NULL
              ELSE least(greatest(m.order_count_vs_history_z - c.med_o, -10.0), 10.0) END AS cd_order_residual,
         CAST(coalesce(c.n, 0) AS BIGINT) AS cd_group_count
  FROM {tag}_masks m LEFT JOIN (
    SELECT transaction_month, company_division_peer_public_id, median(net_revenue_vs_history_z) AS med_s,
           median(order_count_vs_history_z) AS med_o, count(net_revenue_vs_history_z) AS n
    FROM {tag}_masks GROUP BY transaction_month, company_division_peer_public_id) c
  ON m.transaction_month = c.transaction_month
 AND m.company_division_peer_public_id IS NOT DISTINCT FROM c.company_division_peer_public_id""")
    cte(f"{tag}_fb", (f"{tag}_resid",))(f"""
  SELECT *,
    CASE WHEN cd_usable THEN cd_spend_residual ELSE channel_spend END AS hybrid_spend,
    CASE WHEN cd_usable THEN cd_order_residual ELSE channel_order END AS hybrid_order,
    CASE WHEN cd_usable THEN order_value_vs_company_division_peer_z ELSE net_revenue_vs_peer_z END AS hybrid_peer_level,
    (NOT cd_usable) AND channel_sparse AS hybrid_sparse,
    CASE WHEN cd_usable THEN cd_spend_residual ELSE net_revenue_vs_history_z END AS company_division_spend,
    CASE WHEN cd_usable THEN cd_order_residual ELSE order_count_vs_history_z END AS company_division_order,
    order_value_vs_company_division_peer_z AS company_division_peer_level,
    NOT cd_usable AS company_division_sparse,
    net_revenue_vs_peer_z AS channel_peer_level
  FROM (
    SELECT *,
      coalesce(cd_group_count >= {min_peer_rows} AND order_value_vs_company_division_peer_z IS NOT NULL
               AND NOT coalesce(sparse_company_division_peer_group_flag, true), false) AS cd_usable,
      coalesce(sparse_peer_group_flag, true) AS channel_sparse,
      CASE WHEN NOT coalesce(sparse_peer_group_flag, true) THEN net_revenue_vs_peers_resid ELSE net_revenue_vs_history_z END AS channel_spend,
      CASE WHEN NOT coalesce(sparse_peer_group_flag, true) THEN order_count_vs_peers_resid ELSE order_count_vs_history_z END AS channel_order
    FROM {tag}_resid) x""")
    yoy = []
    for c in ("net_revenue_yoy_ratio", "order_count_yoy_ratio"):
        v = f"CASE WHEN fit_mask AND {c} > 0 THEN ln({c}) END"
        yoy.append(f"""median(abs({v})) AS {c}_mad, quantile_cont({v}, 0.75) AS {c}_q3,
         quantile_cont({v}, 0.25) AS {c}_q1, stddev_pop({v}) AS {c}_sd, count({v}) AS {c}_n""")
    cte(f"{tag}_yoyfit", (f"{tag}_fb",))(f"  SELECT {', '.join(yoy)} FROM {tag}_fb")
    sc = []
    for c in ("net_revenue_yoy_ratio", "order_count_yoy_ratio"):
        mad, iqr = f"1.4826 * {c}_mad", f"({c}_q3 - {c}_q1) / 1.349"
        sc.append(f"CASE WHEN {mad} > 0 THEN {mad} WHEN {iqr} > 0 THEN {iqr} WHEN {c}_sd > 0 THEN {c}_sd END AS {c}_scale")
        sc.append(f"CASE WHEN {mad} > 0 THEN 'MAD' WHEN {iqr} > 0 THEN 'IQR' ELSE 'standard_deviation' END AS {c}_method")
        sc.append(f"CAST({c}_n AS BIGINT) AS {c}_observations")
    cte(f"{tag}_yoy", (f"{tag}_yoyfit",))(f"  SELECT {', '.join(sc)} FROM {tag}_yoyfit")

    def clip10(e):
        return f"CASE WHEN ({e}) IS NULL THEN NULL ELSE least(greatest({e}, -10.0), 10.0) END"

    shared = [clip10(c) for c in ("quantity_vs_history_z", "discount_rate_vs_history_z",
                                  "return_rate_vs_history_z", "category_mix_shift_vs_history_z")]
    for c in ("net_revenue_yoy_ratio", "order_count_yoy_ratio"):
        shared.append(clip10(f"CASE WHEN {c} > 0 THEN ln({c}) END / {c}_scale"))
    scores = []
    for s in ("channel", "company_division", "hybrid"):
        sig = [f"{s}_spend", f"{s}_order", f"{s}_peer_level", *shared]
        mx = "greatest(" + ", ".join(f"coalesce(abs({x}), 0.0)" for x in sig) + ")"
        scores.append(f"round(({mx} + CAST(coalesce(zero_order_month_flag, false) AS DOUBLE) * {bonus}) * "
                      f"CASE WHEN coalesce(sparse_history_flag, true) THEN {multiplier} ELSE 1.0 END, 9) AS {s}_s2_score")
    cte(f"{tag}_scores", (f"{tag}_fb", f"{tag}_yoy"))(f"""
  SELECT f.*, {', '.join(scores)}
  FROM {tag}_fb f CROSS JOIN {tag}_yoy y""")
    return f"{tag}_scores"


# --------------------------------------------------------------------------- lens 2
cte("pthr", ("cadence",))("""
  SELECT quantile_cont(next_discount_rate, 0.9) AS discount_p90,
         quantile_cont(next_distinct_product_count, 0.75) AS breadth_p75,
         quantile_cont(next_order_count, 0.75) AS orders_p75
  FROM cadence WHERE data_split = 'train' AND next_has_order = 1""")
cte("lab", ("cadence", "pthr"))("""
  SELECT c.*,
    CASE WHEN next_return_line_rate > 0 THEN 'return_heavy'
         WHEN next_discount_rate > t.discount_p90 THEN 'discount_heavy'
         WHEN next_distinct_product_count >= t.breadth_p75 THEN 'broad'
         WHEN next_order_count >= t.orders_p75 THEN 'multi_order'
         ELSE 'typical' END AS next_active_pattern
  FROM cadence c CROSS JOIN pthr t""")
cte("mk", ("cadence",))("""
  SELECT s.st AS current_has_order, (coalesce(a.s, 0) + 1.0) / (coalesce(a.n, 0) + 2.0) AS p_markov
  FROM (VALUES (0), (1)) s(st)
  LEFT JOIN (SELECT current_has_order, sum(next_has_order) AS s, count(*) AS n
             FROM cadence WHERE data_split = 'train' GROUP BY current_has_order) a
    ON a.current_has_order = s.st""")
cte("gl", ("cadence",))("SELECT avg(CAST(next_has_order AS DOUBLE)) AS p_global FROM cadence WHERE data_split = 'train'")
cte("pprior", ("lab",))("""
  SELECT next_active_pattern AS pattern_class,
         CAST(count(*) AS DOUBLE) / sum(count(*)) OVER () AS pattern_share
  FROM lab WHERE data_split = 'train' AND next_has_order = 1 GROUP BY next_active_pattern""")
cte("pmaj", ("pprior",))("SELECT pattern_class AS majority_pattern FROM pprior ORDER BY pattern_share DESC, pattern_class LIMIT 1")
cte("hb0", ("lab", "mk", "gl", "pprior", "pmaj"))("""
  SELECT l.customer_public_id, l.transaction_month AS feature_month, l.target_month, l.data_split,
         l.next_has_order, coalesce(mk.p_markov, gl.p_global) AS p_next_order,
         CAST(coalesce(mk.p_markov, gl.p_global) >= gl.p_global AS INTEGER) AS predicted_activity,
         -ln(least(greatest(CASE WHEN l.next_has_order = 1 THEN coalesce(mk.p_markov, gl.p_global)
                                 ELSE 1.0 - coalesce(mk.p_markov, gl.p_global) END, 1e-8), 1.0)) AS activity_surprisal,
         CASE WHEN l.next_has_order = 1 THEN l.next_active_pattern ELSE 'not_active' END AS actual_active_pattern,
         CASE WHEN l.next_has_order = 1 THEN pm.majority_pattern ELSE 'not_active' END AS predicted_active_pattern,
         CASE WHEN l.next_has_order = 1 THEN -ln(least(greatest(coalesce(pp.pattern_share, 0.0), 1e-8), 1.0))
              ELSE 0.0 END AS pattern_surprisal
  FROM lab l LEFT JOIN mk ON l.current_has_order = mk.current_has_order
  CROSS JOIN gl CROSS JOIN pmaj pm
  LEFT JOIN pprior pp ON l.next_active_pattern = pp.pattern_class
  WHERE l.data_split = 'forward'""")
cte("hb", ("hb0",))("""
  SELECT *, round(greatest(activity_surprisal, pattern_surprisal), 9) AS hurdle_surprisal_score,
         hurdle_direction <> 'expected' AS hurdle_eligible
  FROM (SELECT *,
          CASE WHEN next_has_order = 0 AND predicted_activity = 1 THEN 'unexpected_inactivity'
               WHEN next_has_order = 1 AND predicted_activity = 0 THEN 'unexpected_activity'
               WHEN next_has_order = 1 AND predicted_activity = 1 AND actual_active_pattern <> predicted_active_pattern
                    THEN 'unexpected_active_pattern'
               ELSE 'expected' END AS hurdle_direction
        FROM hb0) x""")


def waterfill_cte(name: str, src: str, caps, score="hurdle_surprisal_score", direction="hurdle_direction",
                  month="target_month", eligible="hurdle_eligible", prefix="hurdle"):
    if name in CTES:
        return name
    flags = ", ".join(f"coalesce(w.fill_rank <= {k}, false) AS {prefix}_top_{k}" for k in caps)
    cte(name, (src,))(f"""
  SELECT s.*, {flags}
  FROM {src} s LEFT JOIN (
    SELECT customer_public_id, {month},
           row_number() OVER (PARTITION BY {month} ORDER BY within_rank, dir_idx) AS fill_rank
    FROM (SELECT customer_public_id, {month},
                 row_number() OVER (PARTITION BY {month}, {direction} ORDER BY {score} DESC NULLS LAST, customer_public_id) AS within_rank,
                 CASE {direction} WHEN 'unexpected_inactivity' THEN 0 WHEN 'unexpected_activity' THEN 1
                                  WHEN 'unexpected_active_pattern' THEN 2 END AS dir_idx
          FROM {src} WHERE {eligible}
            AND {direction} IN ('unexpected_inactivity', 'unexpected_activity', 'unexpected_active_pattern')) r
  ) w USING (customer_public_id, {month})""")
    return name


def merged_cte(pf: str, hq: str, caps) -> str:
    if "mg" in CTES:
        return "mg"
    pflags = ", ".join(f"p.{s}_top_{k}" for s in ("channel", "company_division", "hybrid") for k in caps)
    hflags = ", ".join(f"h.hurdle_top_{k}" for k in caps)
    cte("mg", (pf, hq))(f"""
  SELECT p.customer_public_id, p.transaction_month, p.channel_s2_score, p.company_division_s2_score,
         p.hybrid_s2_score, {pflags}, h.target_month, h.feature_month, h.next_has_order, h.p_next_order,
         h.hurdle_direction, h.hurdle_surprisal_score, h.hurdle_eligible, {hflags}
  FROM {pf} p JOIN {hq} h ON p.customer_public_id = h.customer_public_id AND p.transaction_month = h.target_month
  WHERE p.forward""")
    return "mg"


def episode_sql(flags_sql: str, lens: str) -> str:
    """Gaps-and-islands episodes over a flag subquery (customer_public_id, transaction_month,
    score, flag, signal_direction)."""
    w = "PARTITION BY customer_public_id ORDER BY transaction_month"
    mn = "(year(transaction_month) * 12 + month(transaction_month))"
    return f"""
SELECT customer_public_id, CAST(episode_number AS BIGINT) AS episode_number, min(transaction_month) AS first_month,
       max(transaction_month) AS last_month, count(*) AS months_flagged,
       (round(CAST(max(score) AS DOUBLE), 6) + 0.0) AS max_score,
       arg_max(signal_direction, transaction_month) AS signal_direction, '{lens}' AS lens,
       CASE WHEN count(*) = 1 THEN 'new' ELSE 'ongoing' END AS episode_status,
       substr(sha256(concat_ws('|', '{lens}', customer_public_id, CAST(CAST(episode_number AS BIGINT) AS VARCHAR))), 1, 16) AS episode_id
FROM (SELECT *, sum(CASE WHEN coalesce(gap <> 1, true) OR dchg THEN 1 ELSE 0 END)
                  OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS episode_number
      FROM (SELECT *, {mn} - lag({mn}) OVER ({w}) AS gap,
                   signal_direction IS DISTINCT FROM lag(signal_direction) OVER ({w}) AS dchg
            FROM ({flags_sql}) f0 WHERE flag) f1) f2
GROUP BY customer_public_id, episode_number"""


def pilot_ctes(mg: str, cap: int, targets, prefix: str) -> str:
    if "alloc" in CTES:
        return "alloc"
    masks = {
        "agreement_core": f"channel_top_{cap} AND hurdle_top_{cap}",
        "channel_only": f"channel_top_{cap} AND NOT hurdle_top_{cap}",
        "hurdle_only": f"hurdle_top_{cap} AND NOT channel_top_{cap}",
        "peer_definition_disagreement": f"(channel_top_{cap} <> company_division_top_{cap}) OR (channel_top_{cap} <> hybrid_top_{cap})",
        "background": f"NOT (channel_top_{cap} OR hurdle_top_{cap} OR company_division_top_{cap} OR hybrid_top_{cap})",
    }
    cte("lt", (mg,))(f"SELECT * FROM {mg} WHERE transaction_month = (SELECT max(transaction_month) FROM {mg})")

    def draw(seed):
        return (f"row_number() OVER (ORDER BY md5(concat_ws('|', '{seed}', customer_public_id, "
                f"strftime(transaction_month, '%Y-%m-%d'))), customer_public_id)")

    prev = []
    for off, (name, n) in enumerate(targets):
        excl = "".join(f" AND customer_public_id NOT IN (SELECT customer_public_id FROM st_{p})" for p in prev)
        cte(f"st_{name}", ("lt", *[f"st_{p}" for p in prev]))(f"""
  SELECT * EXCLUDE (d), '{name}' AS sampling_stratum FROM (
    SELECT *, {draw(42 + off)} AS d FROM lt WHERE ({masks[name]}){excl}) x WHERE d <= {n}""")
        prev.append(name)
    total = sum(n for _, n in targets)
    union = " UNION ALL ".join(f"SELECT * FROM st_{p}" for p in prev)
    cte("alloc0", tuple(f"st_{p}" for p in prev))(f"  {union}")
    cte("fill", ("lt", "alloc0"))(f"""
  SELECT * EXCLUDE (d), 'capacity_fill' AS sampling_stratum FROM (
    SELECT *, {draw(42 + 99)} AS d FROM lt
    WHERE customer_public_id NOT IN (SELECT customer_public_id FROM alloc0)) x
  WHERE d <= greatest({total} - (SELECT count(*) FROM alloc0), 0)""")
    sizes = ", ".join(f"sum(CASE WHEN {m} THEN 1 ELSE 0 END) AS {n}" for n, m in masks.items())
    cte("psizes", ("lt",))(f"  SELECT {sizes}, count(*) AS latest_rows FROM lt")
    filled = " + ".join(f"least({n}, {t})" for n, t in targets)
    probs = " UNION ALL ".join(
        f"SELECT '{n}' AS sampling_stratum, least(1.0, {t}.0 / greatest(1, {n})) AS inclusion_probability FROM psizes"
        for n, t in targets)
    probs += (f" UNION ALL SELECT 'capacity_fill', least(1.0, greatest(0, {total} - ({filled})) / "
              f"greatest(1, latest_rows - ({filled}))) FROM psizes")
    cte("pprob", ("psizes",))(f"  {probs}")
    cte("alloc", ("alloc0", "fill", "pprob"))(f"""
  SELECT a.*, p.inclusion_probability,
         substr(sha256(concat_ws('|', '{prefix}', a.customer_public_id, strftime(a.transaction_month, '%Y-%m'))), 1, 16) AS case_id
  FROM (SELECT * FROM alloc0 UNION ALL SELECT * FROM fill) a LEFT JOIN pprob p USING (sampling_stratum)""")
    return "alloc"


# --------------------------------------------------------------------------- dirty variants
_K = "md5(concat_ws('|', customer_public_id, strftime(transaction_month, '%Y-%m-%d')))"


def _h(pos: int) -> str:
    return f"substr(k, {pos}, 1)"


_NUM = ("company_division_peer_customer_count", *PEER_INPUT_COLUMNS[8:])
_NUM_AT = (4, 5, 6, 7, 9, *range(22, 31))  # hex digits that no other defect uses
_FLG = ("sparse_history_flag", "sparse_peer_group_flag", "sparse_company_division_peer_group_flag")
cte("dirty0", ("scored",))(f"""
  SELECT CASE WHEN {_h(1)} = '0' THEN NULL ELSE customer_public_id END AS customer_public_id,
         CASE WHEN {_h(2)} = '1' THEN 'bad-month' ELSE strftime(transaction_month, '%Y-%m-%d') END AS transaction_month,
         ('0x' || substr(k, 10, 12))::BIGINT AS ingest_seq,
         {", ".join(f"CASE WHEN {_h(3)} = '2' THEN NULL ELSE {c} END AS {c}" for c in _FLG)},
         CASE WHEN {_h(3)} = '3' THEN NULL ELSE zero_order_month_flag END AS zero_order_month_flag,
         {", ".join(f"CASE WHEN {_h(i)} = '4' THEN 'NaN' WHEN {_h(i)} = '5' THEN 'n/a' ELSE CAST({c} AS VARCHAR) END AS {c}" for i, c in zip(_NUM_AT, _NUM))},
         {_h(8)} = 'e' AS dup
  FROM (SELECT *, {_K} AS k FROM scored) s""")
cte("dirty", ("dirty0",))("""
  SELECT * EXCLUDE (dup) FROM dirty0
  UNION ALL BY NAME
  SELECT * EXCLUDE (dup) REPLACE (ingest_seq + 1 AS ingest_seq, 'n/a' AS order_count_vs_history_z)
  FROM dirty0 WHERE dup""")


def _coerce(c: str) -> str:
    v = f"TRY_CAST({c} AS DOUBLE)"
    return f"CASE WHEN isnan({v}) THEN NULL ELSE {v} END"


cte("cleaned", ("dirty",))(f"""
  SELECT customer_public_id, transaction_month, ingest_seq,
         {", ".join(f"coalesce({c}, true) AS {c}, {c} IS NULL AS filled_{c}" for c in _FLG)},
         coalesce(zero_order_month_flag, false) AS zero_order_month_flag,
         zero_order_month_flag IS NULL AS filled_zero_order_month_flag,
         {", ".join(f"{_coerce(c)} AS {c}, ({c} IS NOT NULL AND {_coerce(c)} IS NULL) AS coerced_{c}" for c in _NUM)}
  FROM (SELECT * EXCLUDE (transaction_month),
               CAST(date_trunc('month', try_strptime(transaction_month, '%Y-%m-%d')) AS DATE) AS transaction_month,
               row_number() OVER (PARTITION BY customer_public_id, CAST(date_trunc('month', try_strptime(transaction_month, '%Y-%m-%d')) AS DATE)
                                  ORDER BY ingest_seq DESC) AS rk
        FROM dirty
        WHERE customer_public_id IS NOT NULL AND try_strptime(transaction_month, '%Y-%m-%d') IS NOT NULL) d
  WHERE rk = 1""")
