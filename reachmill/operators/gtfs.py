"""Timetables: active services on a date, activity in a window, projection, and policy filters."""

from __future__ import annotations

import datetime
import zoneinfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import ContractError, require, require_none

DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
# Policy of the study.
EXCLUDED_ROUTE_TYPES = ["715"]
BUS_ROUTE_TYPES = ["3", "200", "712", "713"]
WINDOW = ("10:00:00", "11:00:00", "Europe/Paris")


def column_of(df: DataFrame, name: str) -> Column:
    """A column by name whatever its case; null if absent, an error if ambiguous."""
    found = [c for c in df.columns if c.lstrip("﻿").lower() == name.lower()]
    if len(found) > 1:
        raise ContractError(f"ambiguous column {name}")
    return F.col(f"`{found[0]}`").cast("string") if found else F.lit(None).cast("string")


def service_date(value) -> datetime.date:
    if isinstance(value, datetime.datetime):
        value = value.date()
    if isinstance(value, datetime.date):
        return value
    for form in ("%Y%m%d", "%Y-%m-%d"):
        try:
            return datetime.datetime.strptime(str(value), form).date()
        except ValueError:
            continue
    raise ContractError(f"not a service date: {value}")


def local_date(instant: Column, zone: str = WINDOW[2]) -> Column:
    """The date that a UTC instant has in a time zone."""
    return F.to_date(F.from_utc_timestamp(instant, zone))


def resolve_service_date(departure=None, explicit=None, zone: str = WINDOW[2]) -> datetime.date:
    """An explicit date, or the local date of a departure instant; an instant without a zone is UTC."""
    if explicit is not None:
        return service_date(explicit)
    if not isinstance(departure, datetime.datetime):
        raise ContractError("a service date needs an explicit date or a departure instant")
    if departure.tzinfo is None:
        departure = departure.replace(tzinfo=datetime.timezone.utc)
    return departure.astimezone(zoneinfo.ZoneInfo(zone)).date()


def seconds(clock: Column) -> Column:
    """HH:MM:SS to seconds of the service day; hours may pass 24; anything else is null."""
    part = F.split(F.trim(clock), ":")
    valid = F.trim(clock).rlike(r"^[0-9]+:[0-5]?[0-9]:[0-5]?[0-9]$")
    n = lambda i: F.try_element_at(part, F.lit(i)).try_cast("long")
    return F.when(valid, n(1) * 3600 + n(2) * 60 + n(3))


def clock_seconds(text: str) -> int:
    h, m, s = (int(p) for p in text.split(":"))
    if not (0 <= m < 60 and 0 <= s < 60 and h >= 0):
        raise ContractError(f"not a clock time: {text}")
    return h * 3600 + m * 60 + s


def activity_window(window) -> tuple[int, int]:
    values = [window["start"], window["end"]] if isinstance(window, dict) else list(window)[:2]
    start, end = (clock_seconds(v) for v in values)
    if start >= end:
        raise ContractError("activity window must increase")
    return start, end


def active_services(calendar: DataFrame | None, calendar_dates: DataFrame | None, date, by=()) -> DataFrame:
    """service_id of the services that run on a date: the weekday's calendar, less removals, plus additions.

    ``by``, here and below, names columns that tell feeds apart: every table
    has them, and nothing of one feed meets another's.
    """
    if calendar is None and calendar_dates is None:
        raise ContractError("a feed needs calendar or calendar_dates")
    date = service_date(date)
    day = int(date.strftime("%Y%m%d"))
    sides = []
    if calendar is not None:
        number = lambda c: F.replace(column_of(calendar, c), F.lit("-"), F.lit("")).try_cast("int")
        runs = (column_of(calendar, DAYS[date.weekday()]).try_cast("int") == 1) & (number("start_date") <= day) & (number("end_date") >= day)
        sides.append(calendar.where(runs).select(*by, column_of(calendar, "service_id").alias("service_id")))
    if calendar_dates is not None:
        kind = F.coalesce(column_of(calendar_dates, "exception_type"), column_of(calendar_dates, "exception_date"))
        own = calendar_dates.where(F.replace(column_of(calendar_dates, "date"), F.lit("-"), F.lit("")).try_cast("int") == day)
        ids = [*by, column_of(calendar_dates, "service_id").alias("service_id")]
        added, removed = own.where(kind == "1").select(*ids), own.where(kind == "2").select(*ids)
        sides = [s.join(removed, [*by, "service_id"], "left_anti") for s in sides] + [added]
    out = sides[0]
    for s in sides[1:]:
        out = out.unionByName(s)
    return out.where("service_id is not null").distinct()


def activity(active: DataFrame, trips: DataFrame, stop_times: DataFrame, window=WINDOW, by=()) -> DataFrame:
    """n_active_trips, n_window_trips, n_active_stops; the window is half open and does not restrict stops."""
    start, end = activity_window(window)
    running = trips.join(active, [*by, "service_id"], "left_semi").select(*by, "trip_id").distinct()
    calls = stop_times.join(running, [*by, "trip_id"], "left_semi").withColumn("at", seconds(F.col("departure_time")))
    inside = (F.col("at") >= start) & (F.col("at") < end)
    one = running.groupBy(*by).agg(F.count("*").alias("n_active_trips"))
    two = calls.groupBy(*by).agg(F.count_distinct(F.when(inside, F.col("trip_id"))).alias("n_window_trips"), F.count_distinct("stop_id").alias("n_active_stops"))
    if not by:
        return one.join(two)
    counts = ["n_active_trips", "n_window_trips", "n_active_stops"]
    return one.join(two, list(by), "left").select(*by, *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts])


def project_services(calendar_dates: DataFrame, active: DataFrame, target, by=()) -> DataFrame:
    """calendar_dates with the target date's exceptions replaced by additions of the active services."""
    target = service_date(target).strftime("%Y%m%d")
    kept = calendar_dates.where(~(F.replace("date", F.lit("-"), F.lit("")) == target)).select(*by, "service_id", "date", "exception_type")
    return kept.unionByName(active.select(*by, "service_id", F.lit(target).alias("date"), F.lit("1").alias("exception_type")))


def parent_orphans(stops: DataFrame, by=()) -> DataFrame:
    """Stops whose parent station is no stop of the feed."""
    children = stops.where("parent_station is not null and parent_station <> ''")
    return children.join(stops.select(*by, F.col("stop_id").alias("parent_station")), [*by, "parent_station"], "left_anti").select(*by, "stop_id", "parent_station")


def route_type_cascade(routes: DataFrame, trips: DataFrame, stop_times: DataFrame, excluded=tuple(EXCLUDED_ROUTE_TYPES), frequencies: DataFrame | None = None, by=()) -> dict[str, DataFrame]:
    """The tables without routes of the excluded types and all that hangs on them."""
    gone = routes.where(F.col("route_type").cast("string").isin(*excluded)).select(*by, "route_id")
    kept_routes = routes.join(gone, [*by, "route_id"], "left_anti")
    gone_trips = trips.join(gone, [*by, "route_id"], "left_semi").select(*by, "trip_id")
    out = {"routes": kept_routes, "trips": trips.join(gone, [*by, "route_id"], "left_anti"), "stop_times": stop_times.join(gone_trips, [*by, "trip_id"], "left_anti")}
    if frequencies is not None:
        out["frequencies"] = frequencies.join(gone_trips, [*by, "trip_id"], "left_anti")
    return out


def school_filter(routes: DataFrame, trips: DataFrame, feed: str, policy: dict, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Routes and trips without those that the feed's policy marks as school service.

    ``policy`` holds whole_feeds, route_ids, route_short_name_patterns and
    trip_text_patterns, the last three by feed, and bus_route_types.  Ids may
    carry the feed's prefix.  Marked routes that are no buses raise when strict.
    """
    known = {*policy["whole_feeds"], *policy["route_ids"], *policy["route_short_name_patterns"], *policy["trip_text_patterns"], *policy.get("reviewed_public_feeds", [])}
    if feed not in known:
        raise ContractError(f"no school-service policy for feed {feed}")
    bare = F.when(F.col("route_id").startswith(f"{feed}:"), F.substring("route_id", len(feed) + 2, 1_000_000)).otherwise(F.col("route_id"))
    if feed in policy["whole_feeds"]:
        marked = F.col("route_id").isNotNull() & (F.col("route_id") != "")
    else:
        marked = F.coalesce(bare.isin(*policy["route_ids"].get(feed, [])), F.lit(False))
    pattern = policy["route_short_name_patterns"].get(feed)
    if pattern:
        require(routes, ["route_short_name"], feed)
        marked = marked | F.coalesce("route_short_name", F.lit("")).rlike(f"(?i){pattern}")
    if strict and (feed not in policy["whole_feeds"] or feed in policy.get("whole_feed_route_type_validation", [])):
        require_none(routes.where(marked & ~F.coalesce(F.col("route_type").cast("string").isin(*policy["bus_route_types"]), F.lit(False))).select("route_id"), "school-service policy matched a route that is no bus")
    gone = routes.where(marked).select("route_id")
    kept = trips.join(gone, "route_id", "left_anti")
    text = policy["trip_text_patterns"].get(feed)
    if text:
        columns = [c for c in ("trip_headsign", "trip_short_name") if c in trips.columns]
        if not columns:
            raise ContractError(f"school-service policy of {feed} needs a trip text column")
        for c in columns:
            kept = kept.where(~F.coalesce(F.col(c), F.lit("")).rlike(f"(?i){text}"))
    return routes.join(gone, "route_id", "left_anti"), kept


def select_feeds(feeds: DataFrame, regime: str, excluded=(), prefix: str = "gtfsx_") -> DataFrame:
    """Feeds of a regime that the router reads: derived ones by prefix less the excluded, or the primary ones by role."""
    readers = F.array_contains("readers", "r5r-transit")
    own = F.col("id").startswith(prefix) & ~F.col("id").isin(*excluded) if regime == "derived" else F.col("pin_key_role") == "primary-D1"
    return feeds.where(readers & F.coalesce(own, F.lit(False)))


def feed_gate(summary: DataFrame, required) -> None:
    """Raises unless every required feed has an active trip, a trip in the window and a stop."""
    rows = summary.where(F.col("feed_id").isin(*required))
    require_none(rows.where("n_active_trips < 1 or n_window_trips < 1 or n_active_stops < 1").select("feed_id"), "required feed without service")
    missing = {*required} - {r[0] for r in rows.select("feed_id").distinct().collect()}
    if missing:
        raise ContractError(f"required feed(s) missing: {', '.join(sorted(missing))}")
