"""Station <-> route bridge and passenger-weighted station delay (APT)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import weighted_mean


def route_bridge(stations: DataFrame) -> DataFrame:
    """One row per (complex, route, division, borough) from the stop table.

    ``daytime_routes`` is split on single spaces, so doubled spaces yield empty
    tokens, which are dropped after trimming; a null route list yields no row.
    """
    tokens = F.array_distinct(F.filter(F.transform(F.split("daytime_routes", " "), lambda t: F.trim(t)), lambda t: t != ""))
    keys = ["complex_id", "division", F.col("borough").alias("borough_code")]
    return (
        stations.select(*keys, F.explode(tokens).alias("route"))
        .distinct()
        .select("complex_id", "route", "division", "borough_code")
    )


def station_delay(
    bridge: DataFrame,
    apt: DataFrame,
    line_aliases: DataFrame | None = None,
    period: str = "peak",
) -> DataFrame:
    """Passenger-weighted APT and journey-time measure per station-month.

    Each distinct (complex, route) pair counts once, even when a route is
    listed under two divisions. ``line_aliases`` (route, line) optionally maps
    route tokens to APT line names first (e.g. a shuttle token to its line).
    Both sides are small dimensions (stations x routes, lines x months); the
    optimizer broadcasts whichever its size checks allow.
    """
    routes = bridge.select("complex_id", "route").distinct()
    if line_aliases is not None:
        aliases = line_aliases.select(F.col("route").alias("_alias_route"), F.col("line").alias("_alias_line"))
        routes = (
            routes.join(aliases, routes["route"] == aliases["_alias_route"], "left")
            .select("complex_id", F.coalesce("_alias_line", "route").alias("route"))
            .distinct()
        )
    served = apt.filter(F.col("period") == period).join(routes, F.col("line") == F.col("route"))
    riders = "num_passengers"
    return served.groupBy("complex_id", "year", F.col("month_num").alias("month")).agg(
        weighted_mean("additional_platform_time", riders).alias("apt_minutes"),
        weighted_mean("customer_journey_time", riders).alias("cjtp"),
        F.sum(riders).alias("total_line_passengers"),
        F.count("line").alias("num_lines_serving"),
    )
