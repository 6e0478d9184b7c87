"""Table-building plans: silver pings/trips/routes, the gold fact, layer runs."""

from transitlake.plans.daily import (
    GOLD_FACT,
    attach_ping_metrics,
    daily_performance,
    enrich_trips,
    gold_rules,
    ping_metrics,
    route_lookup,
    trip_indicators,
)
from transitlake.plans.pings import SILVER_PINGS, silver_pings
from transitlake.plans.routes import SILVER_ROUTES, silver_routes
from transitlake.plans.trips import SILVER_TRIPS, silver_trips

__all__ = [
    "GOLD_FACT",
    "SILVER_PINGS",
    "SILVER_ROUTES",
    "SILVER_TRIPS",
    "attach_ping_metrics",
    "daily_performance",
    "enrich_trips",
    "gold_rules",
    "ping_metrics",
    "route_lookup",
    "silver_pings",
    "silver_routes",
    "silver_trips",
    "trip_indicators",
]
