"""Column expressions for the derived order, score and session fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leakscope.config import DEFAULT_PARAMS, RuleParams
from leakscope.sources.schemas import ENUMS


def dec(value: str | int, precision: int = 10, scale: int = 4) -> Column:
    """Exact decimal literal, so that money arithmetic never passes through a double."""
    return F.lit(str(value)).cast(f"decimal({precision},{scale})")


def cairo_day(ts: Column) -> Column:
    """Calendar day of a UTC instant in the business time zone."""
    local = F.convert_timezone(F.lit("UTC"), F.lit("Africa/Cairo"), ts.cast("timestamp_ntz"))
    return F.to_date(local)


def order_month(ts: Column) -> Column:
    return F.trunc(cairo_day(ts), "month")


def order_quarter(ts: Column) -> Column:
    return F.trunc(cairo_day(ts), "quarter")


def order_year(ts: Column) -> Column:
    return F.year(cairo_day(ts))


def month_label(month: Column) -> Column:
    """``April 2024`` style label of a month start."""
    return F.date_format(month, "MMMM yyyy")


def price_after_discount(price: Column, discount: Column) -> Column:
    # kept to 18 digits, which Spark computes on longs
    kept = (F.lit(1) - discount).cast("decimal(4,3)")
    return F.round(price * kept, 2).cast("decimal(12,2)")


def total_profit(revenue: Column, logistics: Column, params: RuleParams = DEFAULT_PARAMS) -> Column:
    overhead = revenue * dec(params.overhead_rate, 4, 2)
    return F.round(revenue - logistics - overhead, 2).cast("decimal(14,2)")


def ratio(numerator: Column, denominator: Column, kind: str) -> Column:
    """Quotient to 4 places, NULL on a zero denominator."""
    return F.round(F.try_divide(numerator, denominator), 4).cast(kind)


def profit_margin(profit: Column, revenue: Column) -> Column:
    return ratio(profit, revenue, "decimal(7,4)")


def fee_to_cost_ratio(fee: Column, cost: Column) -> Column:
    return ratio(fee, cost, "decimal(10,4)")


def shipping_delay_days(delivered: Column, estimated: Column) -> Column:
    """Positive when the parcel came late."""
    return F.datediff(F.to_date(delivered), F.to_date(estimated))


def ensemble_score(if_score: Column, lof_score: Column, params: RuleParams = DEFAULT_PARAMS) -> Column:
    blended = if_score * dec(params.if_weight, 4, 2) + lof_score * dec(params.lof_weight, 4, 2)
    return F.round(blended, 6).cast("decimal(8,6)")


def risk_tier(score: Column, params: RuleParams = DEFAULT_PARAMS) -> Column:
    return (
        F.when(score.isNull(), F.lit(None).cast("string"))
        .when(score < dec(params.tier_medium), "Low")
        .when(score < dec(params.tier_high), "Medium")
        .when(score < dec(params.tier_critical), "High")
        .otherwise("Critical")
    )


def enum_rank(col: Column, domain: str) -> Column:
    """Position of a value in its declared domain, the order the platform sorts by."""
    values = F.array(*[F.lit(v) for v in ENUMS[domain]])
    return F.nullif(F.array_position(values, col), F.lit(0))


def session_minutes(start: Column, end: Column) -> Column:
    seconds = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return F.round(seconds / F.lit(60_000_000), 2).cast("decimal(8,2)")


def token_cost_usd(input_tokens: Column, output_tokens: Column) -> Column:
    return (input_tokens * dec("0.000003", 10, 6) + output_tokens * dec("0.000015", 10, 6)).cast("decimal(10,6)")


def rate_pct(part: Column, total: Column) -> Column:
    """Share in percent, 0..100, NULL on an empty base."""
    return F.try_divide(F.lit(100.0) * part, total)


def mean(col: Column) -> Column:
    """Average as exact sum over count, one division at the end, NULL on no values."""
    return F.try_divide(F.sum(col).cast("double"), F.count(col))


def text_or_empty(*parts: Column | str) -> Column:
    """Concatenation that skips NULL parts."""
    cols = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    return F.concat_ws("", *cols)


def shorten(col: Column, width: int = 60) -> Column:
    """Text cut to ``width`` characters with an ellipsis."""
    return F.when(F.length(col) > width, F.concat(F.substring(col, 1, width), F.lit("…"))).otherwise(col)


def segment(lifetime_value: Column, params: RuleParams = DEFAULT_PARAMS) -> Column:
    return (
        F.when(lifetime_value > dec(params.segment_high, 14, 2), "High Value")
        .when(lifetime_value > dec(params.segment_mid, 14, 2), "Mid Value")
        .otherwise("Low Value")
    )
