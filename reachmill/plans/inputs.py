"""Inputs of a run from the acquired files: communes and their territories, and the destinations with their registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmill.functions.contracts import BORDER_WIDTH_M, require
from reachmill.operators import universe
from reachmill.operators.ranking import numbered
from reachmill.sources import io
from reachmill.sources.geopackage import read_geopackage

COMMUNES = ["code_insee", "nom_officiel", "code_insee_du_departement", "code_insee_de_la_region", "codes_siren_des_epci"]
#: What a listing must agree on to be another's duplicate, besides every other column of the universe.
LISTING = ["SIRET", "NOMRS", "TYPEQU", "LONGITUDE", "LATITUDE", "DEP", "DEPCOM", "zone"]


def commune_crosswalk(spark: SparkSession, path: str, folder: str, departements=None) -> DataFrame:
    """The crosswalk of the layer ``commune`` of a geopackage, kept in a folder under the file's digest; departements are picked from what is kept."""
    make = lambda: universe.commune_crosswalk(read_geopackage(spark, path, "commune", COMMUNES), strict=True)
    kept = io.cached(spark, folder, {"commune_crosswalk": io.sha256_file(path)}, make)
    return kept.where(F.col("code_departement").isin(*departements)) if departements else kept


def destination_universe(equipment: DataFrame, edges: DataFrame, departements, strip_departements=None, width: float = BORDER_WIDTH_M) -> DataFrame:
    """Kept equipment of the region and its strip, with zone and universe_row: 1, 2, ... by departement, commune and type, and then by all else.

    With ``strip_departements`` only their equipment can be in the strip.
    """
    near = equipment if strip_departements is None else equipment.where(F.col("DEP").isin(*departements, *strip_departements))
    kept = universe.region_universe(near, edges, departements, width).drop("distance_m")
    first = ["DEP", "DEPCOM", "TYPEQU"]
    require(kept, first, "equipment")
    order = F.struct(*first, *[c for c in kept.columns if c not in first])
    return numbered(kept.withColumn("_order", order), "_order", "universe_row").drop("_order")


def destination_plan(kept: DataFrame) -> dict[str, DataFrame]:
    """destinations, dest_map and the lossless registry of a destination_universe, with its facts.

    Rows that agree in all columns share the listing of the first of them; rows
    without coordinates are no destinations.
    """
    require(kept, ["universe_row", *LISTING], "universe")
    listed = universe.listing_registry(kept, [c for c in kept.columns if c != "universe_row"])
    registry = listed.select("universe_row", "id", F.col("id").alias("base_id"), "TYPEQU", "SIRET", "NOMRS", "DEP", "DEPCOM", F.col("LONGITUDE").alias("lon"), F.col("LATITUDE").alias("lat"), "zone")
    one = registry.groupBy("id").agg(F.first("lon").alias("lon"), F.first("lat").alias("lat"), F.first("TYPEQU").alias("TYPEQU"))
    return {"destinations": one.select("id", "lon", "lat"), "dest_map": one.select("id", "TYPEQU"), "registry": registry, "facts": universe_facts(kept)}


def universe_facts(kept: DataFrame) -> DataFrame:
    """One row of counts over a universe: its rows, those with coordinates, zones, identifiers and points."""
    there = F.col("LONGITUDE").isNotNull() & F.col("LATITUDE").isNotNull()
    empty = there & (F.col("SIRET") == "")
    point = F.struct("LONGITUDE", "LATITUDE")
    return kept.agg(
        F.count("*").alias("n_universe"), F.count_if(there).alias("n_routable"), F.count_if(~there).alias("n_na_coord"), F.count_if(F.col("zone") == "region").alias("n_region"), F.count_if(F.col("zone") == "strip").alias("n_strip"),
        F.count_if(F.col("SIRET").isNull()).alias("n_siret_na"), (F.count("*") - F.count_distinct("SIRET") - F.max(F.when(F.col("SIRET").isNull(), 1).otherwise(0))).alias("n_siret_shared"),
        F.count_if(empty).alias("n_empty_siret"), F.count_distinct(F.when(there, point)).alias("n_pts"), F.count_distinct(F.when(empty, point)).alias("n_empty_pts"),
    )


def label_folder(label: str) -> str:
    """A run's label as the name of a folder: anything but letters, digits, dot, dash and underscore becomes one dash."""
    import re

    return re.sub(r"[^A-Za-z0-9_.-]+", "-", label)
