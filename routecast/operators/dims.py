"""Dimensions (P5, A3, C20).

No join here or elsewhere carries a broadcast hint: whether a dimension is
broadcast is decided by ``spark.sql.autoBroadcastJoinThreshold`` and, from
real stage sizes, by AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routecast.functions import classifiers as C


def dim_routes(stg_routes: DataFrame) -> DataFrame:
    return stg_routes.select(
        "route_id", "route_name", "origin", "destination", "distance_km",
        "vehicle_type", "base_fare_eur", "frequency_daily",
    )


def dim_vehicles(stg_vehicles: DataFrame) -> DataFrame:
    return stg_vehicles.select("vehicle_id", "vehicle_type", "capacity", "registration_plate", "year_manufactured", "status")


def delay_category_attributes(category: str = "delay_category", domain: str = "delay_domain") -> list:
    """C20 columns for a (category, domain) pair."""
    return [
        C.controllability(domain).alias("controllability"),
        C.sla_threshold_minutes(category).alias("sla_threshold_minutes"),
        C.expected_frequency_tier(category).alias("expected_frequency_tier"),
        C.mitigation_strategy(category).alias("mitigation_strategy"),
        C.cascade_risk_factor(category).alias("cascade_risk_factor"),
    ]


def dim_delay_categories(stg_incidents: DataFrame) -> DataFrame:
    """A3 + C20: distinct valid categories with SLA and mitigation metadata."""
    cats = (
        stg_incidents.filter(~F.col("_is_invalid_record"))
        .select("delay_category", "delay_domain")
        .distinct()
    )
    return cats.select(
        F.md5("delay_category").alias("delay_category_key"),
        "delay_category",
        "delay_domain",
        *delay_category_attributes(),
    )
