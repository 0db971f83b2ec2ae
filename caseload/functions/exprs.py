"""Column-expression helpers. All JVM-side, codegen-friendly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["month_number", "clip", "safe_div", "realized_prob_surprisal", "md5_order_key", "month_start", "clip_prob"]


def month_start(c) -> Column:
    """Any date/timestamp (incl. timestamp_ntz) -> first day of month as DATE."""
    return F.trunc(F.to_date(c), "MM")


def month_number(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 12 + F.month(c)).cast("bigint")


def clip(c, lo: float | None, hi: float | None) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    if lo is not None:
        c = F.when(c.isNull(), None).otherwise(F.greatest(c, F.lit(float(lo))))
    if hi is not None:
        c = F.when(c.isNull(), None).otherwise(F.least(c, F.lit(float(hi))))
    return c


def safe_div(num, den, eps: float = 0.0) -> Column:
    """num/den, NULL unless den > eps (no ANSI error, no infinities)."""
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den > F.lit(eps), num / den)


def clip_prob(p, lo: float = 1e-8, hi: float = 1 - 1e-8) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return F.least(F.greatest(p, F.lit(lo)), F.lit(hi))


def realized_prob_surprisal(y, p) -> Column:
    """-ln(clip(P(realized), 1e-8, 1))."""
    y = F.col(y) if isinstance(y, str) else y
    p = F.col(p) if isinstance(p, str) else p
    realized = F.when(y == 1, p).otherwise(F.lit(1.0) - p)
    return -F.ln(F.least(F.greatest(realized, F.lit(1e-8)), F.lit(1.0)))


def md5_order_key(*parts) -> Column:
    """Deterministic pseudo-random 60-bit key from md5 of the joined parts."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("bigint")
