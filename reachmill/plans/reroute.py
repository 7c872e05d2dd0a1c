"""Runs over the addresses that no routed point serves, on the parameters of a base run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import ContractError
from reachmill.operators import monolith, routing
from reachmill.operators.universe import address_universe
from reachmill.plans.runner import COMPLETE, Run


def reroute_inputs(origins: DataFrame, links: DataFrame, address_points: DataFrame, existing_points: DataFrame, departements=None, strict: bool = False) -> DataFrame:
    """The address universe of some departements' constructions; links and the national address table are reduced to them first."""
    own = origins.where(F.col("code_departement_insee").isin(*departements)) if departements else origins
    near = links.join(own.select("origin_id").distinct(), "origin_id", "left_semi")
    points = address_points.join(near.select("address_id").distinct(), "address_id", "left_semi")
    return address_universe(own, near, points, existing_points, strict)


def reroute_key(addresses: DataFrame, links: DataFrame) -> str:
    """The plan's key: a digest of the addresses and of the links that they were counted from."""
    return routing.plan_key({"addresses": addresses, "links": links.select("origin_id", "address_id").distinct()})


def base_destinations(base: Run) -> DataFrame:
    """id, ord, lon, lat of the destinations as the base run planned them, from its own tables."""
    points = base.plan_table("dest_points").select(F.col("id").alias("point_id"), "lon", "lat")
    return base.plan_table("dest_link").join(points, "point_id").select("id", F.col("id").alias("ord"), "lon", "lat")


def reroute_run(base: Run, folder: str, addresses: DataFrame, dest_map: DataFrame, plan_key: str, chunk_size: int | None = None) -> Run:
    """The run of the rerouted addresses under their own ids, with the base run's destinations, modes, cap, router and departure.

    The key freezes the plan: the run cannot be taken up with another one.  A base run that is not complete raises.
    """
    owed = [e for e in base.manifest["entries"] if e["status"] != COMPLETE]
    if owed:
        raise ContractError(f"the base run owes {len(owed)} chunk(s)")
    points = addresses.where("routing_source = 'reroute' and lon is not null and lat is not null").select(F.col("address_id").alias("id"), F.col("address_id").alias("ord"), "lon", "lat")
    return Run(folder, points, base_destinations(base), dest_map, base.modes, chunk_size or base.chunk_size, base.cap, base.router, base.identity["router"], base.departure, plan_key)


def address_table(base: Run, rerouted: Run | None, origin_link: DataFrame, addresses: DataFrame, strict: bool = False) -> DataFrame:
    """The wide address table of a base run and the run of its rerouted addresses; a run that owes chunks raises."""
    wide = lambda run: monolith.with_gains(monolith.widen(run.matrix(strict=True)), run.transit())
    other = wide(rerouted) if rerouted is not None else None
    return monolith.build_wide(base.matrix(strict=True), base.transit(), origin_link, addresses, other, strict)
