"""All feeds of a study in one plan: the timetable operators over lines of many archives, keyed by feed_id.

``lines`` is a table of lines or, so that each member is read by itself, what
sources.timetables.archives gives.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import ContractError, require_none
from reachmill.operators import gtfs
from reachmill.sources.timetables import all_lines, member_lines, member_table, of_members

BY = ("feed_id",)
CALENDAR = ["service_id", *gtfs.DAYS, "start_date", "end_date"]
DATES = ["service_id", "date", "exception_type"]


def active_services(lines, date) -> DataFrame:
    """feed_id, service_id of the services that run on a date."""
    return gtfs.active_services(member_table(lines, "calendar.txt", CALENDAR), member_table(lines, "calendar_dates.txt", DATES), date, BY)


def summary(lines, date, window=gtfs.WINDOW) -> DataFrame:
    """feed_id, n_active_trips, n_window_trips, n_active_stops of every feed that has trips or a calendar, as feed_gate wants them."""
    found = gtfs.activity(active_services(lines, date), member_table(lines, "trips.txt", ["trip_id", "service_id"]), member_table(lines, "stop_times.txt", ["trip_id", "stop_id", "departure_time"]), window, BY)
    counts = [c for c in found.columns if c.startswith("n_")]
    every = of_members(lines, "trips.txt", "calendar.txt", "calendar_dates.txt").select("feed_id").distinct()
    return every.join(found, "feed_id", "left").select("feed_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts])


def require_members(lines, required=("stops.txt", "trips.txt", "stop_times.txt", "routes.txt")) -> None:
    """Raises with the feeds that lack a member, or lines in it."""
    lines = all_lines(lines)
    held = lines.where(F.col("member").isin(*required)).groupBy("feed_id").agg(F.count_distinct("member").alias("n"))
    short = lines.select("feed_id").distinct().join(held, "feed_id", "left").where(F.coalesce("n", F.lit(0)) < len(required))
    require_none(short.select("feed_id"), "feed without all its members")


def project(lines, source_date, target_date) -> DataFrame:
    """The lines with the services of one date running on another, too; all other members stay."""
    dates = member_table(lines, "calendar_dates.txt", DATES)
    new = gtfs.project_services(dates, active_services(lines, source_date), target_date, BY)
    return all_lines(lines).where("member <> 'calendar_dates.txt'").unionByName(member_lines(new, "calendar_dates.txt", ["service_id", "date", "exception_type"]))


def without_route_types(lines, excluded=tuple(gtfs.EXCLUDED_ROUTE_TYPES)) -> DataFrame:
    """The lines without routes of the excluded types, their trips, and what hangs on these."""
    key = lambda c: F.col("fields")[c].alias(c)
    gone = of_members(lines, "routes.txt").where(F.col("fields")["route_type"].isin(*excluded)).select("feed_id", key("route_id")).distinct()
    trips = of_members(lines, "trips.txt").select("feed_id", key("route_id"), key("trip_id")).join(gone, ["feed_id", "route_id"], "left_semi").select("feed_id", "trip_id").distinct()
    return _less(lines, gone, trips)


def without_school_service(lines, policy: dict) -> DataFrame:
    """The lines without routes and trips that a policy (see gtfs.school_filter) marks; a feed that it doesn't name raises."""
    per_feed = ("route_ids", "route_short_name_patterns", "trip_text_patterns")
    known = {*policy["whole_feeds"], *policy.get("reviewed_public_feeds", []), *(f for k in per_feed for f in policy[k])}
    unknown = sorted(r[0] for r in all_lines(lines).select("feed_id").distinct().where(~F.col("feed_id").isin(*known)).limit(6).collect())
    if unknown:
        raise ContractError(f"no school-service policy for feed(s) {', '.join(unknown)}")
    value = lambda c: F.coalesce(F.col("fields")[c], F.lit(""))
    bare = F.when(value("route_id").startswith(F.concat("feed_id", F.lit(":"))), F.substr(value("route_id"), F.length("feed_id") + 2)).otherwise(value("route_id"))
    marked, texts = F.col("feed_id").isin(*policy["whole_feeds"]) & (value("route_id") != "") if policy["whole_feeds"] else F.lit(False), F.lit(False)
    for feed in sorted(known):  # the policy is a short document
        own = F.col("feed_id") == feed
        if policy["route_ids"].get(feed):
            marked = marked | (own & bare.isin(*policy["route_ids"][feed]))
        if policy["route_short_name_patterns"].get(feed):
            marked = marked | (own & value("route_short_name").rlike(f"(?i){policy['route_short_name_patterns'][feed]}"))
        if policy["trip_text_patterns"].get(feed):
            text = f"(?i){policy['trip_text_patterns'][feed]}"
            texts = texts | (own & (value("trip_headsign").rlike(text) | value("trip_short_name").rlike(text)))
    gone = of_members(lines, "routes.txt").where(marked).select("feed_id", F.col("fields")["route_id"].alias("route_id")).distinct()
    trips = of_members(lines, "trips.txt").select("feed_id", F.col("fields")["route_id"].alias("route_id"), F.col("fields")["trip_id"].alias("trip_id"), texts.alias("by_text"))
    trips = trips.join(gone.withColumn("by_route", F.lit(True)), ["feed_id", "route_id"], "left").where("by_route or by_text").select("feed_id", "trip_id").distinct()
    return _less(lines, gone, trips)


def _less(lines, routes: DataFrame, trips: DataFrame) -> DataFrame:
    """The lines without some routes, some trips and the lines of trips; other members stay."""
    lines = all_lines(lines)
    route, trip = F.col("fields")["route_id"], F.col("fields")["trip_id"]
    kept = lines.withColumn("_route", F.when(F.col("member") == "routes.txt", route)).withColumn("_trip", F.when(F.col("member").isin("trips.txt", "stop_times.txt", "frequencies.txt"), trip))
    kept = kept.join(routes.select("feed_id", F.col("route_id").alias("_route")), ["feed_id", "_route"], "left_anti")
    return kept.join(trips.select("feed_id", F.col("trip_id").alias("_trip")), ["feed_id", "_trip"], "left_anti").select(lines.columns)
