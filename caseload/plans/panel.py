"""Customer-month panels derived from the order tables.

Plan shape (one big shuffle-join, then only reduced data moves):

* orders x lineitem on ``orderkey`` (sort-merge at scale; no skew, orderkey is unique in orders),
  part attached by ``partkey`` (broadcast only when AQE measures it under the threshold);
* aggregation to (customer, month, part) and (customer, month, type) in one exchange by customer and month:
  a customer holding a third of all lines is reduced before any shuffle on customer alone;
* one exchange by customer joins lines and orders to the months with orders (``active_months``), the only rows that are written;
* the panel's rows, from each customer's first order month to the last order month of the data, are those months and the
  quiet months after each (``sequence`` + ``explode``), made where they are read: no join with a spine, no shuffle;
* per-customer windows over at most (panel months) rows each -- bounded partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseload.config import PanelConfig
from caseload.functions.exprs import month_number, month_start, safe_div
from caseload.operators.joins import join_cells
from caseload.operators.ranking import cell_medians
from caseload.session import scratch_table
from caseload.sources.contracts import ENGINEERED_COLUMNS
from caseload.sources.tables import read_table

HIST_MEASURES = ("net_revenue", "order_count", "quantity", "discount_rate", "return_rate",
                 "category_mix_shift")
SD_EPS = 1e-9


def _orders(spark, sf_dir) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    return (o.where(F.col("o_custkey").isNotNull() & F.col("o_orderdate").isNotNull())
             .select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_date"),
                     month_start("o_orderdate").alias("transaction_month")))


def typed_lines(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Order lines joined to their order's customer/month and part type, aggregated to the
    (customer, month, part type) grain."""
    orders = _orders(spark, sf_dir)
    returned = F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), 1).otherwise(0)
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
                     "l_returnflag", "l_linestatus"]).select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount",
                                                             returned.alias("return_line"))
    part = read_table(spark, sf_dir, "part", ["p_partkey", "p_type"])
    lines = (li.join(orders.select("o_orderkey", "o_custkey", "transaction_month"),
                     li.l_orderkey == orders.o_orderkey)
               .join(part, li.l_partkey == part.p_partkey, "left"))
    # One exchange by customer and month serves both aggregates: hardly any part occurs twice in a month, so summing
    # before it would save nothing, and a hot customer's lines are dealt by month.
    lines = lines.repartition("o_custkey", "transaction_month")
    # p_type is a function of the part, so grouping by both keeps the part grain without a
    # string aggregate (which would force a sort-based aggregation).
    per_part = lines.groupBy("o_custkey", "transaction_month", "p_type", "l_partkey").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("l_extendedprice").alias("gross"),
        F.sum(F.col("l_extendedprice") * F.col("l_discount")).alias("discount_amount"),
        F.sum(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("net"),
        F.sum("l_quantity").alias("quantity"),
        F.sum(F.when(F.col("p_type") == "PROMO", 1).otherwise(0)).alias("promo_lines"),
        F.sum("return_line").alias("return_lines"),
    )
    # type grain: parts are disjoint across types, so distinct parts and the top part add up
    typed = per_part.groupBy("o_custkey", "transaction_month", "p_type").agg(
        F.sum("lines").alias("type_lines"), F.count("l_partkey").alias("parts"),
        F.sum("gross").alias("gross"), F.sum("discount_amount").alias("discount_amount"),
        F.sum("net").alias("net"), F.sum("quantity").alias("quantity"),
        F.sum("promo_lines").alias("promo_lines"), F.sum("return_lines").alias("return_lines"),
        F.max("net").alias("top_part_net"))
    return typed


LINE_MEASURES = ("type_lines", "parts", "gross", "discount_amount", "net", "quantity", "promo_lines", "return_lines", "top_part_net")


def active_months(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig(), typed: DataFrame | None = None) -> DataFrame:
    """One row per customer and month with orders: panel measures, revenue/quantity/mix inputs and ``quiet_months``, the
    months without orders that follow it (up to the next month with orders or the end of the data).

    Lines by type and orders by month meet in one exchange by customer and one aggregate by month."""
    orders = _orders(spark, sf_dir)
    keys = ["o_custkey", "transaction_month"]
    day = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth("order_date") - 1)  # a month's days are a set of 31 bits
    order_month = orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("order_count"), F.bit_or(day).alias("days"))
    typed = typed_lines(spark, sf_dir, cfg) if typed is None else typed
    rows = typed.select(*keys, "p_type", *LINE_MEASURES).unionByName(order_month, allowMissingColumns=True)
    months = with_prior_counts(rows).groupBy(*keys, "mn").agg(
        F.max("order_count").alias("order_count"), F.max(F.bit_count("days")).cast("bigint").alias("active_order_days"),
        F.sum("type_lines").alias("line_count"),
        F.sum("parts").alias("distinct_product_count"),
        F.sum("gross").alias("gross_revenue"),
        F.sum("discount_amount").alias("discount_amount"),
        F.sum("net").alias("net_revenue"),
        F.sum("quantity").alias("quantity"),
        F.sum("promo_lines").alias("promo_lines"),
        F.sum("return_lines").alias("return_lines"),
        F.max("top_part_net").alias("top_part_net"),
        category_mix_shift().alias("category_mix_shift"),
    )
    last = orders.agg(F.max("transaction_month").alias("panel_end"))  # one row: the panel ends with the data
    w = Window.partitionBy("o_custkey").orderBy("mn")
    upto = F.coalesce(F.lead("mn").over(w) - 1, month_number("panel_end"))
    lc = F.col("line_count")
    return months.crossJoin(F.broadcast(last)).select(
        F.col("o_custkey").cast("string").alias("customer_public_id"),
        "o_custkey",
        "transaction_month",
        F.min("transaction_month").over(w).alias("first_observed_month"),
        F.col("order_count").cast("bigint").alias("order_count"),
        "active_order_days",
        F.coalesce("distinct_product_count", F.lit(0)).cast("bigint").alias("distinct_product_count"),
        safe_div("discount_amount", "gross_revenue").alias("discount_rate"),
        safe_div(F.col("promo_lines").cast("double"), lc).alias("promo_line_share"),
        safe_div(F.col("return_lines").cast("double"), lc).alias("return_line_rate"),
        safe_div("top_part_net", "net_revenue").alias("top_product_revenue_share"),
        F.coalesce("net_revenue", F.lit(0.0)).alias("net_revenue"),
        F.coalesce("quantity", F.lit(0.0)).alias("quantity"),
        "category_mix_shift",
        "mn",
        (upto - F.col("mn")).cast("int").alias("quiet_months"),
    )


#: What a month without orders holds of each measure.
QUIET = {"order_count": 0, "active_order_days": 0, "distinct_product_count": 0, "discount_rate": None, "promo_line_share": None,
         "return_line_rate": None, "top_product_revenue_share": None, "net_revenue": 0.0, "quantity": 0.0, "category_mix_shift": None}


def with_quiet_months(months: DataFrame) -> DataFrame:
    """Dense customer-month facts (wide): every row of ``active_months`` and the quiet months after it."""
    rows = months.select("*", F.explode(F.sequence(F.lit(0), F.col("quiet_months"))).alias("_after"))
    kept = {f.name: f.dataType for f in months.schema.fields}
    return rows.select("customer_public_id", "o_custkey", F.add_months("transaction_month", F.col("_after")).alias("transaction_month"),
                       "first_observed_month",
                       *[F.when(F.col("_after") == 0, F.col(c)).otherwise(F.lit(v).cast(kept[c])).alias(c) for c, v in QUIET.items()])


def monthly_facts(spark: SparkSession, sf_dir: str, cfg: PanelConfig = PanelConfig(),
                  typed: DataFrame | None = None) -> DataFrame:
    """Dense customer-month facts (wide): panel measures + revenue/quantity/mix inputs.

    ``typed`` is the (customer, month, part type) line aggregate, made from the order tables if it is not given."""
    return with_quiet_months(active_months(spark, sf_dir, cfg, typed))


def with_prior_counts(rows: DataFrame) -> DataFrame:
    """``rows`` (lines by customer, month and type, and rows without lines) and, for every row, its month's lines and the
    customer's lines of all prior months, of its type and in all. One exchange by customer: a customer has at most one row
    a month and type, and one a month without lines."""
    prior = lambda *keys: Window.partitionBy("o_custkey", *keys).orderBy("mn").rangeBetween(Window.unboundedPreceding, -1)
    rows = rows.repartition("o_custkey").withColumn("mn", month_number("transaction_month"))
    rows = rows.select("*", F.when(F.col("type_lines").isNotNull(), F.coalesce(F.sum("type_lines").over(prior("p_type")), F.lit(0))).alias("prior_type_lines"))
    return rows.select("*", F.sum("type_lines").over(Window.partitionBy("o_custkey").orderBy("mn").rangeBetween(0, 0)).alias("month_lines"),
                       F.sum("type_lines").over(prior()).alias("prior_lines"))


def category_mix_shift() -> Column:
    """Total-variation distance between a month's line mix over ``p_type`` and the customer's
    cumulative mix over all prior months, an aggregate over a month's rows of ``with_prior_counts``.

    With a = this month's type counts (total A) and b = prior cumulative counts (total B):
    TV = 0.5 * (sum_{t in a} |a_t/A - b_t/B| + 1 - sum_{t in a} b_t/B).
    Only types present this month need a row, so no dense (month x type) grid is built.
    """
    a = F.col("type_lines") / F.col("month_lines")
    b = F.when(F.col("prior_lines") > 0, F.col("prior_type_lines") / F.col("prior_lines"))
    return F.lit(0.5) * (F.sum(F.abs(a - b)) + F.lit(1.0) - F.sum(b))


def engineered_panel(facts: DataFrame) -> DataFrame:
    """The ten-column engineered customer-month contract."""
    return facts.select(*ENGINEERED_COLUMNS)


def customer_peers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Peer cells per customer: channel = market segment, company/division = (nation, segment)."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey", "c_mktsegment"])
    cd = F.substring(F.sha2(F.concat_ws("|", F.col("c_nationkey").cast("string"), F.col("c_mktsegment")), 256), 1, 12)
    c = c.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("channel_peer"),
                 cd.alias("company_division_peer_public_id"))
    sizes = c.groupBy("company_division_peer_public_id").agg(
        F.count(F.lit(1)).alias("company_division_peer_customer_count"))
    return c.join(sizes, "company_division_peer_public_id", "left")


def history_panel(facts: DataFrame, peers: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """Per-customer window pass: history z of six measures, prior-row count, 12-row YoY ratios.
    One Exchange + Window on the customer key, which the join with the peers shares; every partition holds whole customers."""
    w = Window.partitionBy("o_custkey").orderBy("transaction_month")
    prior = w.rowsBetween(Window.unboundedPreceding, -1)
    df = facts.join(peers, "o_custkey", "left")
    cols = [F.col(c) for c in df.columns]
    for m in HIST_MEASURES:
        x = F.col({"return_rate": "return_line_rate"}.get(m, m)).cast("double")
        mean = F.avg(x).over(prior)
        sd = F.stddev_samp(x).over(prior)
        cols.append(F.when(sd > SD_EPS, (x - mean) / sd).alias(f"{m}_vs_history_z"))
    cols.append((F.row_number().over(w) - 1).alias("prior_rows"))
    for m in ("net_revenue", "order_count"):
        lag12 = F.lag(F.col(m).cast("double"), 12).over(w)
        cols.append(F.when(lag12 > 0, F.col(m).cast("double") / lag12).alias(f"{m}_yoy_ratio"))
    rev = F.log1p(F.col("net_revenue"))
    order_value = F.log1p(F.when(F.col("order_count") > 0, F.col("net_revenue") / F.col("order_count"))
                          .otherwise(F.lit(0.0)))
    return df.select(*cols, rev.alias("_rev_l"), order_value.alias("_ov_l"))


#: What the scored panel reads of the history; the rest is not written.
HISTORY_COLUMNS = ("customer_public_id", "transaction_month", "order_count", "channel_peer", "company_division_peer_public_id",
                   "company_division_peer_customer_count", *[f"{m}_vs_history_z" for m in HIST_MEASURES], "prior_rows",
                   "net_revenue_yoy_ratio", "order_count_yoy_ratio", "_rev_l", "_ov_l")

DENSE_MEASURES = HIST_MEASURES[:3]  # zero in a quiet month; the others are NULL there
YOY_MEASURES = HIST_MEASURES[:2]
YEAR = 12


def history_states(months: DataFrame) -> DataFrame:
    """``active_months`` with what ``history_from_states`` needs to make ``history_panel``'s rows without a window over them:
    the z of the month and the YoY ratios; for the quiet months after it, the sum and the squared deviations (of months with
    orders, this one included) of revenue, orders and quantity, and for each ratio in which of them it is 0 (a bit a month).

    Among the n prior months, k had orders, with sum s and squared deviations d about their mean; the n - k others are zeros, so the
    mean is s / n and the squared deviations about it are d + (s / k)^2 k (n - k) / n, the merging rule of variances."""
    w = Window.partitionBy("o_custkey").orderBy("mn")
    prior, year_ago, months_11 = w.rowsBetween(Window.unboundedPreceding, -1), w.rangeBetween(-YEAR, -YEAR), w.rangeBetween(1 - YEAR, -1)
    cols = [(F.row_number().over(w) - 1).alias("_k"), (F.col("mn") - month_number("first_observed_month")).cast("double").alias("_n")]
    for m in DENSE_MEASURES:
        x = F.col(m).cast("double")
        cols += [F.coalesce(F.sum(x).over(prior), F.lit(0.0)).alias(f"_s_{m}"), F.coalesce(F.var_pop(x).over(prior) * F.count(x).over(prior), F.lit(0.0)).alias(f"_d_{m}")]
    for m in HIST_MEASURES[3:]:
        x = F.col({"return_rate": "return_line_rate"}.get(m, m)).cast("double")
        sd = F.stddev_samp(x).over(prior)
        cols.append(F.when(sd > SD_EPS, (x - F.avg(x).over(prior)) / sd).alias(f"{m}_vs_history_z"))
    had = F.call_function("shiftleft", F.lit(1), F.pmod("mn", F.lit(16)).cast("int"))
    for m in YOY_MEASURES:
        x = F.col(m).cast("double")
        ago = F.max(x).over(year_ago)
        cols += [F.when(ago > 0, x / ago).alias(f"{m}_yoy_ratio"), F.coalesce(F.sum(F.when(x > 0, had)).over(months_11), F.lit(0)).alias(f"_had_{m}")]
    rows = months.select("*", *cols)
    k, n = F.col("_k").cast("double"), F.col("_n")
    out = [F.col("_k") + 1]
    for m in DENSE_MEASURES:
        x, s, d = F.col(m).cast("double"), F.col(f"_s_{m}"), F.col(f"_d_{m}")
        sd = F.when(n >= 2, F.sqrt((d + F.when(k > 0, (s / k) * (s / k) * k * (n - k) / n).otherwise(0.0)) / (n - 1)))
        step = F.when(k > 0, (x - s / k) * (x - s / k) * k / (k + 1)).otherwise(0.0)
        out += [F.when(sd > SD_EPS, (x - s / n) / sd).alias(f"{m}_vs_history_z"), (s + x).alias(f"_sum_{m}"), (d + step).alias(f"_dev_{m}")]
    for m in YOY_MEASURES:  # the month j after has one of the 11 months before, or the month itself, a year before
        at = lambda j: F.call_function("shiftleft", F.lit(1), F.pmod(F.col("mn") + (j - YEAR), F.lit(16)).cast("int"))
        months_had = sum((F.when(F.col(f"_had_{m}").bitwiseAND(at(j)) != 0, 1 << j).otherwise(0) for j in range(1, YEAR)), F.when(F.col(m) > 0, 1 << YEAR).otherwise(0))
        out.append(months_had.alias(f"_zero_ratio_{m}"))
    return rows.select(*months.columns, *[f"{m}_vs_history_z" for m in HIST_MEASURES[3:]], *[f"{m}_yoy_ratio" for m in YOY_MEASURES],
                       F.col("_n").cast("int").alias("prior_rows"), out[0].cast("double").alias("_active"), *out[1:])


def history_from_states(states: DataFrame) -> DataFrame:
    """The rows of ``history_panel``, each from its customer's last month with orders: a projection and an ``explode``."""
    j = F.col("_after")
    rows = states.select(
        "*", F.log1p("net_revenue").alias("_rev_l"), F.log1p(F.col("net_revenue") / F.col("order_count")).alias("_ov_l"),
        *[(F.col(f"_sum_{m}") * F.col(f"_sum_{m}") / F.col("_active")).alias(f"_square_{m}") for m in DENSE_MEASURES],
        F.explode(F.sequence(F.lit(0), F.col("quiet_months"))).alias("_after"))
    rows = rows.withColumn("_n", (F.col("prior_rows") + j).cast("double")).withColumn("_others", F.lit(1.0) - F.col("_active") / F.greatest(F.col("_n"), F.lit(1.0)))
    rows = rows.withColumns({f"_sd_{m}": F.sqrt((F.col(f"_dev_{m}") + F.col(f"_square_{m}") * F.col("_others")) / F.greatest(F.col("_n") - 1, F.lit(1.0))) for m in DENSE_MEASURES})
    in_month = lambda c, quiet=None: F.when(j == 0, F.col(c)).otherwise(quiet).alias(c)
    z = lambda m: F.when((F.col("_n") > 1) & (F.col(f"_sd_{m}") > SD_EPS), -F.col(f"_sum_{m}") / F.col("_n") / F.col(f"_sd_{m}"))
    ratio = lambda m: F.when((j <= YEAR) & (F.col(f"_zero_ratio_{m}").bitwiseAND(F.call_function("shiftleft", F.lit(1), j)) != 0), 0.0)
    return rows.select(
        "customer_public_id", F.add_months("transaction_month", j).alias("transaction_month"),
        F.when(j == 0, F.col("order_count")).otherwise(F.lit(0).cast("bigint")).alias("order_count"), "channel_peer", "company_division_peer_public_id",
        "company_division_peer_customer_count", *[in_month(f"{m}_vs_history_z", z(m)) for m in DENSE_MEASURES], *[in_month(f"{m}_vs_history_z") for m in HIST_MEASURES[3:]],
        (F.col("prior_rows") + j).alias("prior_rows"), *[in_month(f"{m}_yoy_ratio", ratio(m)) for m in YOY_MEASURES],
        in_month("_rev_l", F.lit(0.0)), in_month("_ov_l", F.lit(0.0)))


def peers_are_unique(peers: DataFrame) -> bool:
    """Whether no customer has two rows of peer cells."""
    return not peers.where("o_custkey IS NOT NULL").groupBy("o_custkey").count().where("count > 1").limit(1).count()


def scored_panel(history: DataFrame, cfg: PanelConfig = PanelConfig()) -> DataFrame:
    """The 21-column scored panel from the history stage: peer z, peer residuals, flags.

    Peer cells are (month, channel) and (month, company/division): grouped aggregates with
    partial aggregation and distributed medians. They are written before they are joined back by cell, so that Spark
    knows their size and the panel's rows stay where they are."""
    df = history
    cells = ["transaction_month", "channel_peer"]
    level = {"_ch_mean": F.avg("_rev_l"), "_ch_sd": F.stddev_samp("_rev_l"), "_ch_rows": F.count(F.lit(1))}
    ch = cell_medians(df, cells, ["net_revenue_vs_history_z", "order_count_vs_history_z"], also=level).withColumnsRenamed(
        {"median_net_revenue_vs_history_z": "_ch_med_rev_z", "median_order_count_vs_history_z": "_ch_med_oc_z"})
    cd = df.groupBy("transaction_month", "company_division_peer_public_id").agg(
        F.avg("_ov_l").alias("_cd_mean"), F.stddev_samp("_ov_l").alias("_cd_sd"),
        F.count(F.lit(1)).alias("_cd_rows"))
    cd = scratch_table(cd)
    df = join_cells(df, ch, cells)
    df = join_cells(df, cd, ["transaction_month", "company_division_peer_public_id"])
    hz = [F.abs(F.col(f"{m}_vs_history_z")) for m in HIST_MEASURES]
    return df.select(
        "customer_public_id", "transaction_month",
        (F.col("prior_rows") < cfg.min_history_rows).alias("sparse_history_flag"),
        (F.col("_ch_rows") < cfg.min_peer_rows).alias("sparse_peer_group_flag"),
        (F.col("_cd_rows") < cfg.min_peer_rows).alias("sparse_company_division_peer_group_flag"),
        "company_division_peer_public_id",
        F.col("company_division_peer_customer_count").cast("bigint").alias("company_division_peer_customer_count"),
        (F.col("order_count") == 0).alias("zero_order_month_flag"),
        *[f"{m}_vs_history_z" for m in HIST_MEASURES],
        F.when(F.col("_ch_sd") > SD_EPS, (F.col("_rev_l") - F.col("_ch_mean")) / F.col("_ch_sd"))
         .alias("net_revenue_vs_peer_z"),
        F.when(F.col("_cd_sd") > SD_EPS, (F.col("_ov_l") - F.col("_cd_mean")) / F.col("_cd_sd"))
         .alias("order_value_vs_company_division_peer_z"),
        (F.col("net_revenue_vs_history_z") - F.col("_ch_med_rev_z")).alias("net_revenue_vs_peers_resid"),
        (F.col("order_count_vs_history_z") - F.col("_ch_med_oc_z")).alias("order_count_vs_peers_resid"),
        "net_revenue_yoy_ratio", "order_count_yoy_ratio",
        F.greatest(*hz).alias("baseline_anomaly_score"),
    )
