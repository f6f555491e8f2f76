"""Change measures, labels and rebalancing rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rebalancing rule and holiday flag.
NET_FLOW_TOLERANCE = 3
STATION_CAPACITY = 20.0
FLAG_PCT = 30


def pct_change(value: Column, base: Column) -> Column:
    """Change in per cent of ``base``; null when ``base`` is zero or null."""
    return (value - base) / F.nullif(base, F.lit(0)) * 100


def _whole_text(value: Column) -> Column:
    """A whole DOUBLE as text with one decimal, never in scientific notation."""
    return F.concat(value.cast("bigint").cast("string"), F.lit(".0"))


def station_move(net: Column) -> Column:
    """Bikes to add (+) or remove (-); half away from zero."""
    return (
        F.when(net < -NET_FLOW_TOLERANCE, F.round(F.abs(net)))
        .when(net > NET_FLOW_TOLERANCE, -F.round(net))
        .otherwise(F.lit(0.0))
    )


def station_move_text(net: Column) -> Column:
    return (
        F.when(net < -NET_FLOW_TOLERANCE, F.concat(F.lit("Add "), _whole_text(F.round(F.abs(net))), F.lit(" bikes")))
        .when(net > NET_FLOW_TOLERANCE, F.concat(F.lit("Remove "), _whole_text(F.round(net)), F.lit(" bikes")))
        .otherwise("No action needed")
    )


def capacity_share(net: Column) -> Column:
    """The move in per cent of a station's capacity, one decimal."""
    return (
        F.when(net < -NET_FLOW_TOLERANCE, F.round(F.abs(net) / STATION_CAPACITY * 100, 1))
        .when(net > NET_FLOW_TOLERANCE, -F.round(net / STATION_CAPACITY * 100, 1))
        .otherwise(F.lit(0.0))
    )


def forecast_move(net: Column) -> Column:
    """The same rule with half-even rounding and whole numbers."""
    return (
        F.when(net < -NET_FLOW_TOLERANCE, F.bround(F.abs(net)).cast("bigint"))
        .when(net > NET_FLOW_TOLERANCE, -F.bround(net).cast("bigint"))
        .otherwise(F.lit(0).cast("bigint"))
    )


def forecast_move_text(net: Column) -> Column:
    size = F.bround(F.abs(net)).cast("bigint").cast("string")
    return (
        F.when(net < -NET_FLOW_TOLERANCE, F.concat(F.lit("Add "), size, F.lit(" bikes")))
        .when(net > NET_FLOW_TOLERANCE, F.concat(F.lit("Remove "), size, F.lit(" bikes")))
        .otherwise("No action needed")
    )


def rebalancing_flag(pct: Column) -> Column:
    """Flag of a change beyond 30 per cent; null means no action."""
    return F.when(pct > FLAG_PCT, "Add bikes").when(pct < -FLAG_PCT, "Remove bikes").otherwise("No action")


def multiplier(impact_pct: Column) -> Column:
    return F.round(1 + impact_pct / 100.0, 3)


def impact_label(impact_pct: Column) -> Column:
    """``+1.5% increase``, ``-1.5% decrease`` or ``No impact``."""
    text = impact_pct.cast("decimal(20,1)").cast("string")
    return (
        F.when(impact_pct > 0, F.concat(F.lit("+"), text, F.lit("% increase")))
        .when(impact_pct < 0, F.concat(text, F.lit("% decrease")))
        .otherwise("No impact")
    )


def yes_no(flag: Column) -> Column:
    return F.when(flag, "Yes").when(~flag, "No")
