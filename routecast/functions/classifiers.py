"""Row classifiers and derived measures.

Each function maps columns to one new column. Branch order matters: a NULL
input falls through to the ``otherwise`` branch exactly like a searched CASE.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from routecast.functions.mathcols import dec, round_half_up_int, strict_greatest, strict_least


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- fixed values shared with the source models (must not change) ---------
# Delay category -> domain.
CATEGORY_DOMAIN = {
    "traffic_congestion": "infrastructure",
    "road_closure": "infrastructure",
    "weather_conditions": "environmental",
    "mechanical_issue": "fleet",
    "passenger_boarding": "passenger_ops",
    "security_check": "passenger_ops",
    "operational_handover": "internal_ops",
}
# Domain -> controllability (C20).
DOMAIN_CONTROLLABILITY = {
    "internal_ops": "fully_controllable",
    "fleet": "partially_controllable",
    "passenger_ops": "partially_controllable",
    "infrastructure": "uncontrollable",
    "environmental": "uncontrollable",
}
# Category -> SLA threshold in minutes, default 30 (C20).
CATEGORY_SLA_MINUTES = {
    "passenger_boarding": 10,
    "operational_handover": 15,
    "security_check": 20,
    "traffic_congestion": 20,
    "road_closure": 30,
    "weather_conditions": 45,
    "mechanical_issue": 60,
}
DEFAULT_SLA_MINUTES = 30
# Category -> expected frequency tier, default low_frequency (C20).
CATEGORY_FREQUENCY_TIER = {
    "traffic_congestion": "high_frequency",
    "passenger_boarding": "high_frequency",
    "operational_handover": "medium_frequency",
    "weather_conditions": "medium_frequency",
}
# Category -> mitigation strategy, default general_improvement (C20).
CATEGORY_MITIGATION = {
    "traffic_congestion": "route_optimization",
    "road_closure": "route_optimization",
    "weather_conditions": "proactive_scheduling",
    "mechanical_issue": "preventive_maintenance",
    "passenger_boarding": "process_improvement",
    "operational_handover": "staff_training",
    "security_check": "pre_clearance",
}
# Category -> cascade risk factor, default 0.30 (C20).
CATEGORY_CASCADE_RISK = {
    "mechanical_issue": "0.85",
    "road_closure": "0.70",
    "traffic_congestion": "0.50",
    "weather_conditions": "0.60",
    "operational_handover": "0.40",
    "passenger_boarding": "0.20",
    "security_check": "0.15",
}
DEFAULT_CASCADE_RISK = "0.30"
# Incident severities from least to most severe.
INCIDENT_SEVERITY_ORDER = ["negligible", "minor", "moderate", "severe", "critical"]
# Severity tiers of departure delay, in order (C17).
DELAY_SEVERITY_ORDER = ["on_time", "minor_delay", "moderate_delay", "major_delay", "severe_delay"]
# Risk levels from most to least severe.
RISK_LEVEL_ORDER = ["CRITICAL", "HIGH", "MODERATE", "LOW"]
# ---------------------------------------------------------------------------


def _lookup(col: Column, mapping: dict, default) -> Column:
    expr = None
    for key, value in mapping.items():
        cond = col == F.lit(key)
        expr = F.when(cond, value) if expr is None else expr.when(cond, value)
    return expr.otherwise(default)


# The band limits in the functions below are fixed values as well: hours, minutes,
# passengers and shares that the source models state.
def departure_window(ts: Column | str) -> Column:
    """C2."""
    h = F.hour(_c(ts))
    return (
        F.when(h.between(5, 8), "early_morning")
        .when(h.between(9, 11), "morning")
        .when(h.between(12, 14), "midday")
        .when(h.between(15, 17), "afternoon")
        .when(h.between(18, 20), "evening")
        .otherwise("night")
    )


def is_weekend(ts: Column | str) -> Column:
    """Sunday or Saturday."""
    return F.when((F.dayofweek(_c(ts)) - 1).isin(0, 6), True).otherwise(False)


def schedule_density(ts: Column | str) -> Column:
    """C4."""
    h = F.hour(_c(ts))
    return (
        F.when(h.between(7, 9), "high")
        .when(h.between(16, 18), "high")
        .when(h.between(10, 15), "medium")
        .otherwise("low")
    )


def schedule_quarter(version: Column | str) -> Column:
    """First ``Qn`` found wins; NULL if none."""
    v = _c(version)
    return (
        F.when(v.like("%Q1%"), 1)
        .when(v.like("%Q2%"), 2)
        .when(v.like("%Q3%"), 3)
        .when(v.like("%Q4%"), 4)
    ).cast("int")


def schedule_year(version: Column | str) -> Column:
    """Leading four characters as an integer (NULL when not numeric)."""
    return F.left(_c(version), F.lit(4)).try_cast("int")


def computed_severity(delay: Column | str, pax: Column | str) -> Column:
    """C7."""
    d, p = _c(delay), _c(pax)
    return (
        F.when((d > 40) & (p > 30), "critical")
        .when((d > 30) | ((d > 20) & (p > 25)), "severe")
        .when((d > 15) | ((d > 10) & (p > 20)), "moderate")
        .when(d > 5, "minor")
        .otherwise("negligible")
    )


def severity_rank(severity: Column | str) -> Column:
    """Rank of an incident severity; NULL for NULL or an unknown one."""
    return _lookup(_c(severity), {v: i for i, v in enumerate(INCIDENT_SEVERITY_ORDER)}, None)


def delay_domain(category: Column | str) -> Column:
    """C9."""
    return _lookup(_c(category), CATEGORY_DOMAIN, "unknown")


def resolution_category(minutes: Column | str) -> Column:
    """C10."""
    m = _c(minutes)
    return F.when(m <= 15, "rapid").when(m <= 45, "standard").otherwise("prolonged")


def incident_time_band(ts: Column | str) -> Column:
    """C11."""
    h = F.hour(_c(ts))
    return (
        F.when(h.between(6, 9), "morning_rush")
        .when(h.between(10, 15), "midday")
        .when(h.between(16, 19), "evening_rush")
        .otherwise("off_peak")
    )


def rapid_resolution_anomaly(resolution_minutes: Column | str, delay: Column | str) -> Column:
    """Resolved in less than half the delay."""
    return F.when(_c(resolution_minutes) < _c(delay) * dec("0.5"), True).otherwise(False)


def invalid_incident(delay: Column | str, reported: Column | str, resolved: Column | str) -> Column:
    """C13."""
    return (
        F.when(_c(delay) <= 0, True)
        .when(_c(resolved) < _c(reported), True)
        .otherwise(False)
    )


def invalid_schedule(duration: Column | str, dep: Column | str, arr: Column | str) -> Column:
    """C6."""
    return F.when(_c(duration) <= 0, True).when(_c(dep) >= _c(arr), True).otherwise(False)


def ratio_rounded(num: Column | str, den: Column | str, scale: int, precision: int = 10) -> Column:
    """``round(num / nullif(den, 0), scale)`` as a decimal."""
    n = _c(num).cast("decimal(20,0)")
    d = _c(den).cast("decimal(20,0)")
    return F.round(n / F.when(d != 0, d), scale).cast(f"decimal({precision},{scale})")


def on_time(minutes: Column | str, threshold: int = 5) -> Column:
    """NULL counts as not on time."""
    return F.when(_c(minutes) <= threshold, True).otherwise(False)


def delay_severity(minutes: Column | str) -> Column:
    """C17."""
    m = _c(minutes)
    return (
        F.when(m <= 5, "on_time")
        .when(m <= 15, "minor_delay")
        .when(m <= 30, "moderate_delay")
        .when(m <= 60, "major_delay")
        .otherwise("severe_delay")
    )


def probable_cascade(prev_delay: Column | str, turnaround: Column | str) -> Column:
    """C18."""
    return F.when(
        (F.coalesce(_c(prev_delay), F.lit(0)) > 10) & (F.coalesce(_c(turnaround), F.lit(999)) < 60),
        True,
    ).otherwise(False)


def delay_risk_score(
    departure_delay: Column | str,
    is_on_time_: Column | str,
    has_cascading: Column | str,
    rolling_avg: Column | str,
    incident_count: Column | str,
) -> Column:
    """Clamp to 0..100 (NULL-strict), round half away from zero."""
    raw = (
        _c(departure_delay).cast("decimal(20,0)") * dec("1.5")
        + F.when(~_c(is_on_time_), 10).otherwise(0)
        + F.when(_c(has_cascading), 15).otherwise(0)
        + F.when(_c(rolling_avg) > 15, 20).otherwise(0)
        + _c(incident_count) * 5
    )
    return round_half_up_int(strict_least(F.lit(100), strict_greatest(F.lit(0), raw)))


def controllability(domain: Column | str) -> Column:
    """C20."""
    return _lookup(_c(domain), DOMAIN_CONTROLLABILITY, "unknown")


def sla_threshold_minutes(category: Column | str) -> Column:
    """C20."""
    return _lookup(_c(category), CATEGORY_SLA_MINUTES, DEFAULT_SLA_MINUTES).cast("int")


def expected_frequency_tier(category: Column | str) -> Column:
    """C20."""
    return _lookup(_c(category), CATEGORY_FREQUENCY_TIER, "low_frequency")


def mitigation_strategy(category: Column | str) -> Column:
    """C20."""
    return _lookup(_c(category), CATEGORY_MITIGATION, "general_improvement")


def cascade_risk_factor(category: Column | str) -> Column:
    """C20."""
    mapping = {k: dec(v, 3, 2) for k, v in CATEGORY_CASCADE_RISK.items()}
    return _lookup(_c(category), mapping, dec(DEFAULT_CASCADE_RISK, 3, 2)).cast("decimal(3,2)")


def sla_breach(category: Column | str, departure_delay: Column | str, sla: Column | str) -> Column:
    """C21."""
    return F.when(
        _c(category).isNotNull() & (_c(departure_delay) > _c(sla)), True
    ).otherwise(False)


def percentile_band(delay: Column | str, p50: Column | str, p75: Column | str, p90: Column | str) -> Column:
    """C22."""
    d = _c(delay)
    return (
        F.when(d <= _c(p50), "below_median")
        .when(d <= _c(p75), "p50_to_p75")
        .when(d <= _c(p90), "p75_to_p90")
        .otherwise("above_p90")
    )


def z_score(delay: Column | str, mean: Column | str, stddev: Column | str) -> Column:
    """0 when the deviation is not positive (including NULL)."""
    sd = _c(stddev)
    return F.when(sd > 0, F.round((_c(delay) - _c(mean)) / sd, 2)).otherwise(F.lit(0.0))


def delay_cost_eur(departure_delay: Column | str, passengers: Column | str) -> Column:
    """EUR 0.50 per passenger-minute beyond 5 minutes, 2 dp."""
    beyond = strict_greatest(F.lit(0), _c(departure_delay).cast("long") - 5)
    return F.round(
        beyond.cast("decimal(18,0)") * _c(passengers).cast("decimal(10,0)") * dec("0.50", 3, 2), 2
    ).cast("decimal(18,2)")


def season(month: Column | str) -> Column:
    """C25 (NULL outside 1..12)."""
    m = _c(month)
    return (
        F.when(m.isin(12, 1, 2), "Winter")
        .when(m.isin(3, 4, 5), "Spring")
        .when(m.isin(6, 7, 8), "Summer")
        .when(m.isin(9, 10, 11), "Autumn")
    )


def risk_level(cost: Column | str, revenue: Column | str) -> Column:
    """Cost / revenue thresholds; NULL ratio is LOW.

    Decided by products of exact decimals: a quotient would be cut to its
    type's scale, and a ratio just above a threshold would fall below it."""
    share = F.when(_c(revenue) != 0, _c(revenue)).cast("decimal(30,2)")
    c = _c(cost).cast("decimal(30,2)")
    # cost / revenue > t for a negative revenue means cost < t * revenue
    above = lambda t: F.when(share > 0, c > share * dec(t)).otherwise(c < share * dec(t))
    return (
        F.when(above("0.10"), "CRITICAL")
        .when(above("0.05"), "HIGH")
        .when(above("0.02"), "MODERATE")
        .otherwise("LOW")
    )


def risk_level_rank(level: Column | str) -> Column:
    """Sort key for C26 levels: CRITICAL first."""
    return _lookup(_c(level), {v: i for i, v in enumerate(RISK_LEVEL_ORDER)}, len(RISK_LEVEL_ORDER))
