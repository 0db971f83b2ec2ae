"""Lens 2 cadence features (K1-K16): one customer window, targets at t+1, split by target month.

All windows share ``partitionBy(customer).orderBy(month)`` so Catalyst plans one Exchange, one
Sort and one Window pass. Semantics are row-based (previous rows, not calendar months) and the
windows run before the consecutive-month filter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from caseload.config import CADENCE_FEATURES, DEFAULT_CALENDAR, SplitCalendar, assert_no_forbidden
from caseload.functions.exprs import month_number
from caseload.sources.contracts import ENGINEERED_COLUMNS, require_columns

CUR = "customer_public_id"
MONTH = "transaction_month"
TARGETS = ("next_has_order", "next_order_count", "next_distinct_product_count",
           "next_discount_rate", "next_return_line_rate")


def _win():
    return Window.partitionBy(CUR).orderBy(MONTH)


def current_columns(df: DataFrame) -> DataFrame:
    """K1/K2: activity flag and current-month copies (six measures NULL -> 0)."""
    return df.select(
        *df.columns,
        F.coalesce(F.col("order_count") > 0, F.lit(False)).cast("int").alias("current_has_order"),
        F.col("order_count").cast("double").alias("current_order_count"),
        F.coalesce(F.col("active_order_days").cast("double"), F.lit(0.0)).alias("current_active_order_days"),
        F.coalesce(F.col("distinct_product_count").cast("double"), F.lit(0.0)).alias("current_distinct_product_count"),
        F.coalesce("discount_rate", F.lit(0.0)).alias("current_discount_rate"),
        F.coalesce("promo_line_share", F.lit(0.0)).alias("current_promo_line_share"),
        F.coalesce("return_line_rate", F.lit(0.0)).alias("current_return_line_rate"),
        F.coalesce("top_product_revenue_share", F.lit(0.0)).alias("current_top_product_share"),
    )


def running_totals(df: DataFrame) -> DataFrame:
    """Whole-number totals up to each row, whose differences are the sums over the last n rows (no frame is summed anew)."""
    upto = _win().rowsBetween(Window.unboundedPreceding, 0)
    return df.select("*", F.sum("current_has_order").over(upto).alias("_has_upto"), F.coalesce(F.sum("order_count").over(upto), F.lit(0)).alias("_orders_upto"),
                     F.count("order_count").over(upto).alias("_known_upto"))


def rolling_columns(df: DataFrame, frame: str = "rows") -> list:
    """Rolling means/sd, months since active, inactive streak, 12-row lag.

    ``frame='rows'`` (default) counts previous rows; ``frame='calendar'`` counts calendar
    months (``rangeBetween`` on the month number), which differs only where a customer's
    months have gaps."""
    w = _win()
    totals = frame == "rows" and {"_has_upto", "_orders_upto", "_known_upto"} <= set(df.columns)
    if frame == "rows":
        span = lambda n: w.rowsBetween(-(n - 1), 0)
    elif frame == "calendar":
        wc = Window.partitionBy(CUR).orderBy(month_number(MONTH))
        span = lambda n: wc.rangeBetween(-(n - 1), 0)
    else:
        raise ValueError("frame must be 'rows' or 'calendar'")
    out = []
    within = lambda c, n: F.col(c) - F.lag(c, n, 0).over(w)  # noqa: E731  (of the last n rows, by two running totals)
    for n in (3, 6, 12):
        if totals:
            known = within("_known_upto", n)
            out.append((within("_has_upto", n) / F.least(F.row_number().over(w), F.lit(n))).alias(f"active_rate_{n}m"))
            out.append(F.when(known > 0, within("_orders_upto", n) / known).alias(f"order_count_mean_{n}m"))
        else:
            out.append(F.avg("current_has_order").over(span(n)).alias(f"active_rate_{n}m"))
            out.append(F.avg("current_order_count").over(span(n)).alias(f"order_count_mean_{n}m"))
    out.append(F.stddev_samp("current_order_count").over(span(12)).alias("order_count_sd_12m"))
    mn = month_number(MONTH)
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    # month numbers increase along the window, so the forward-filled last active month is a max
    last_active = F.max(F.when(F.col("current_has_order") == 1, mn)).over(upto)
    out.append(F.least(F.lit(999.0), F.greatest(F.lit(0.0),
               F.coalesce((mn - last_active).cast("double"), F.lit(999.0)))).alias("months_since_active"))
    rn = F.row_number().over(w)
    last_active_rn = F.max(F.when(F.col("current_has_order") == 1, rn)).over(upto)
    out.append(F.when(F.col("current_has_order") == 1, F.lit(0.0))
               .otherwise((rn - F.coalesce(last_active_rn, F.lit(0))).cast("double")).alias("inactive_streak"))
    lag12 = F.lag("current_has_order", 12).over(w)
    out.append(lag12.isNotNull().cast("int").alias("same_month_last_year_available"))
    out.append(F.coalesce(lag12, F.lit(0)).cast("int").alias("same_month_last_year_active"))
    for src, dst in (("transaction_month", "target_month"), ("current_has_order", "next_has_order"),
                     ("current_order_count", "next_order_count"),
                     ("current_distinct_product_count", "next_distinct_product_count"),
                     ("current_discount_rate", "next_discount_rate"),
                     ("current_return_line_rate", "next_return_line_rate")):
        out.append(F.lead(src, 1).over(w).alias(dst))
    return out


def split_label(target_col: str = "target_month", cal: SplitCalendar = DEFAULT_CALENDAR):
    """Chronological split by target month."""
    t = F.col(target_col)
    return (F.when(t <= F.lit(cal.train_end), "train")
             .when(t.between(F.lit(cal.calib_start), F.lit(cal.calib_end)), "calibration")
             .when(t.between(F.lit(cal.forward_start), F.lit(cal.forward_end)), "forward")
             .otherwise("unused"))


def build_cadence_panel(engineered: DataFrame, cal: SplitCalendar = DEFAULT_CALENDAR,
                        frame: str = "rows") -> DataFrame:
    """As-of features at month t with targets at t+1; consecutive months only."""
    df = require_columns(engineered, ENGINEERED_COLUMNS, "Engineered panel")
    whole = isinstance(df.schema["order_count"].dataType, (ByteType, ShortType, IntegerType, LongType))
    df = current_columns(df)
    if whole and frame == "rows":
        df = running_totals(df)
    df = df.select(*df.columns, *rolling_columns(df, frame))
    df = df.select(
        *df.columns,
        F.greatest(month_number(MONTH) - month_number("first_observed_month"), F.lit(0))
         .cast("double").alias("tenure_months_asof"),
        F.sin(F.lit(2.0) * F.pi() * F.month(MONTH) / F.lit(12.0)).alias("calendar_month_sin"),
        F.cos(F.lit(2.0) * F.pi() * F.month(MONTH) / F.lit(12.0)).alias("calendar_month_cos"),
    )
    # Windows above, filter after (a filter below the window would change the features).
    df = df.where(F.col("target_month") == F.add_months(MONTH, 1))
    df = df.withColumn("next_has_order", F.col("next_has_order").cast("int"))
    df = df.withColumn("data_split", split_label("target_month", cal))
    assert_no_forbidden(CADENCE_FEATURES)
    return df.select(CUR, MONTH, "target_month", "data_split", *CADENCE_FEATURES, *TARGETS)
