"""Origins, destinations, addresses and territories."""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reachmill.functions.contracts import BORDER_WIDTH_M, ContractError, require, require_none, require_unique
from reachmill.functions.geo import lambert93_to_wgs84, resolve_geometry, wkt_centroid
from reachmill.operators.ranking import numbered
from reachmill.operators.region import region_distance

# Usages that count as residential, quality codes of a location that are kept.
RESIDENTIAL_USAGES = ["Résidentiel individuel", "Résidentiel collectif"]
UNDIFFERENTIATED = "Résidentiel indifférencié"
KEEP_CODES = ["11", "12", "21", "22", "_U"]


def usage_status(groups: DataFrame, usage: DataFrame, residential=tuple(RESIDENTIAL_USAGES)) -> DataFrame:
    """Every group with its usage_status; a group without a usage row is of unknown coverage, not non-residential."""
    rows = groups.select("batiment_groupe_id").join(usage, "batiment_groupe_id", "left")
    known = F.col("usage_principal_bdnb_open")
    return rows.withColumn("usage_status", F.when(known.isNull(), "unknown_coverage").when(known.isin(*residential), "residential").otherwise("non_residential"))


def usage_audit(groups: DataFrame, usage: DataFrame, residential=tuple(RESIDENTIAL_USAGES)) -> DataFrame:
    """usage_status, n_groups."""
    return usage_status(groups, usage, residential).groupBy("usage_status").agg(F.count("*").alias("n_groups"))


def best_relation(relations: DataFrame, order: str = "ord") -> DataFrame:
    """The most reliable relation of each group; ties go to the first in order, null reliability comes last."""
    first = F.row_number().over(Window.partitionBy("batiment_groupe_id").orderBy(F.desc_nulls_last("fiabilite"), order))
    return relations.withColumn("_n", first).where("_n = 1").drop("_n")


def first_construction(constructions: DataFrame) -> DataFrame:
    """The first non-fictive construction of each group by id."""
    n = F.row_number().over(Window.partitionBy("batiment_groupe_id").orderBy("batiment_construction_id"))
    return constructions.where(~F.coalesce("fictive", F.lit(False))).withColumn("_n", n).where("_n = 1").drop("_n")


def relation_stats(relations: DataFrame) -> DataFrame:
    return relations.groupBy("batiment_groupe_id").agg(F.count("*").alias("n_addresses"), F.max("fiabilite").alias("max_fiabilite"))


def dependance_flags(constructions: DataFrame) -> DataFrame:
    """Constructions with is_dependance_candidate: no address of its own while a sibling in its group of two or more has one."""
    group = Window.partitionBy("batiment_groupe_id")
    n, addressed = F.count("*").over(group), F.sum(F.col("has_address").cast("int")).over(group)
    return constructions.withColumn("is_dependance_candidate", (n >= 2) & (addressed >= 1) & ~F.col("has_address"))


def group_address_metrics(groups: DataFrame, relations: DataFrame) -> DataFrame:
    """n_addresses, n_groups, pct: groups by their number of addresses, null for none."""
    counted = groups.select("batiment_groupe_id").join(relation_stats(relations), "batiment_groupe_id", "left")
    by = counted.groupBy("n_addresses").agg(F.count("*").alias("n_groups"))
    total = counted.agg(F.count("*").alias("all"))
    return by.join(total).select("n_addresses", "n_groups", F.bround(F.lit(100.0) * F.col("n_groups") / F.col("all"), 2).alias("pct"))


def residential_groups(groups: DataFrame, usage: DataFrame, departements=None, communes=None, residential=tuple(RESIDENTIAL_USAGES)) -> DataFrame:
    rows = groups
    if departements:
        rows = rows.where(F.col("code_departement_insee").isin(*departements))
    if communes:
        rows = rows.where(F.col("code_commune_insee").isin(*communes))
    kept = usage_status(rows, usage, residential).where("usage_status = 'residential'").select("batiment_groupe_id")
    return rows.join(kept, "batiment_groupe_id", "left_semi")


CONSTRUCTION, GROUP = "batiment_construction", "groupe"


def residential_universe(
    groups: DataFrame, usage: DataFrame, constructions: DataFrame, relations: DataFrame, address_points: DataFrame, departements=None, communes=None, min_fiabilite: int = 0,
    granularity: str = CONSTRUCTION, include_indifferencie: bool = False, drop_fictive_only: bool = True, residential=tuple(RESIDENTIAL_USAGES),
) -> DataFrame:
    """The origins: one row per construction of a residential group, or per group without any; with granularity "groupe" one per group.

    Geometry is taken by precedence (resolve_geometry); a group's construction is
    the first real one by id.  Origins without usable geometry are left out, and
    those that have a fictive one only, unless drop_fictive_only is False.
    Candidates of outbuildings are flagged, not left out.
    """
    if granularity not in (CONSTRUCTION, GROUP):
        raise ContractError(f"granularity must be {CONSTRUCTION} or {GROUP}")
    residential = (*residential, UNDIFFERENTIATED) if include_indifferencie else tuple(residential)
    own = residential_groups(groups, usage, departements, communes, residential)
    within = lambda df: df.join(own.select("batiment_groupe_id"), "batiment_groupe_id", "left_semi")
    rel = within(relations)
    best = best_relation(rel).join(address_points, "address_id", "left").select("batiment_groupe_id", "fiabilite", F.col("x").alias("ax"), F.col("y").alias("ay"))
    cons = within(constructions)
    nothing = [F.lit(None).cast(t).alias(c) for c, t in (("x", "double"), ("y", "double"), ("fictive_cstr", "int"))]
    if granularity == CONSTRUCTION:
        flagged = dependance_flags(cons).select("batiment_groupe_id", F.col("batiment_construction_id").alias("origin_id"), "x", "y", F.col("fictive").cast("int").alias("fictive_cstr"), "is_dependance_candidate", F.lit(CONSTRUCTION).alias("granularity"))
        bare = own.select("batiment_groupe_id").join(cons.select("batiment_groupe_id").distinct(), "batiment_groupe_id", "left_anti")
        rows = flagged.unionByName(bare.select("batiment_groupe_id", F.col("batiment_groupe_id").alias("origin_id"), *nothing, F.lit(False).alias("is_dependance_candidate"), F.lit(GROUP).alias("granularity")))
    else:
        first = first_construction(cons.where("fictive is not null")).select("batiment_groupe_id", "x", "y", F.col("fictive").cast("int").alias("fictive_cstr"))
        rows = own.select("batiment_groupe_id").join(first, "batiment_groupe_id", "left").select("batiment_groupe_id", F.col("batiment_groupe_id").alias("origin_id"), "x", "y", "fictive_cstr", F.lit(False).alias("is_dependance_candidate"), F.lit(GROUP).alias("granularity"))
    used = usage.select("batiment_groupe_id", "usage_principal_bdnb_open").where(F.col("usage_principal_bdnb_open").isin(*residential))
    meta = own.select("batiment_groupe_id", "code_commune_insee", "code_departement_insee", F.col("x").alias("gx"), F.col("y").alias("gy"), F.col("fictive").alias("fictive_groupe")).join(used, "batiment_groupe_id", "left")
    rows = rows.join(meta, "batiment_groupe_id", "left").join(relation_stats(rel), "batiment_groupe_id", "left").join(best, "batiment_groupe_id", "left")
    out = rows.withColumn("geometry", resolve_geometry(min_fiabilite)).select("origin_id", "batiment_groupe_id", "code_commune_insee", "code_departement_insee", "usage_principal_bdnb_open", "granularity", "n_addresses", "max_fiabilite", "is_dependance_candidate", "geometry.*")
    return out.where(F.col("geometry_source") != "fictive") if drop_fictive_only else out.where(F.col("geometry_source").isNotNull())


def classify_zone(dep: Column, distance_m: Column, departements, width: float = BORDER_WIDTH_M) -> Column:
    """region by department first, then strip by a distance under the width, else null."""
    return F.when(F.coalesce(dep.isin(*departements), F.lit(False)), "region").when(distance_m < width, "strip")


def geoloc_kept(quality: Column, street: Column) -> Column:
    return F.coalesce(quality.isin(*KEEP_CODES), F.lit(False)) | F.coalesce(F.length(street) > 0, F.lit(False))


def equipment_universe(equipment: DataFrame, distance_m: Column, departements, width: float = BORDER_WIDTH_M) -> DataFrame:
    """Located equipment of the region and of the strip around it."""
    rows = equipment.withColumn("zone", classify_zone(F.col("DEP"), distance_m, departements, width)).where("zone is not null")
    return rows.where(geoloc_kept(F.col("QUALITE_GEOLOC"), F.col("LIBVOIE")))


def strip_only_types(universe: DataFrame) -> DataFrame:
    """Types that only the strip has."""
    strip, region = (universe.where(F.col("zone") == z).select("TYPEQU").distinct() for z in ("strip", "region"))
    return strip.join(region, "TYPEQU", "left_anti")


def listing_registry(universe: DataFrame, columns, order: str = "universe_row", prefix: str = "bpe_listing") -> DataFrame:
    """Every routable row with the id of its listing: equal rows (nulls equal) share the id of their first appearance."""
    routable = universe.dropna("any", subset=["LONGITUDE", "LATITUDE"])
    firsts = routable.groupBy(*columns).agg(F.min(order).alias("_first"))
    firsts = numbered(firsts, "_first", "_number")
    firsts = firsts.select(*columns, F.format_string(f"{prefix}_%06d", "_number").alias("id"))
    same = reduce(lambda a, b: a & b, [F.col(f"u.{c}").eqNullSafe(F.col(f"l.{c}")) for c in columns])
    return routable.alias("u").join(firsts.alias("l"), same).select("u.*", "l.id")


def destination_facts(registry: DataFrame) -> DataFrame:
    empty = F.coalesce(F.col("SIRET"), F.lit("")) == ""
    return registry.agg(
        F.count("*").alias("n_rows"), F.count_distinct("id").alias("n_listings"), F.count_distinct("LONGITUDE", "LATITUDE").alias("n_points"), F.count_if(empty).alias("n_empty_siret"),
        F.count_if(F.col("zone") == "region").alias("n_region"), F.count_if(F.col("zone") == "strip").alias("n_strip"),
    )


def select_origins(origins: DataFrame, ids) -> DataFrame:
    """The origins with the requested ids; none at all raises, some that are missing give a warning with their number."""
    wanted = sorted(set(ids))
    found = origins.where(F.col("origin_id").isin(*wanted))
    matched = found.select("origin_id").distinct().count() if wanted else 0
    if not matched:
        raise ContractError("no origin matches the requested ids")
    if matched < len(wanted):
        warnings.warn(f"{len(wanted) - matched} of {len(wanted)} requested origins are unknown", stacklevel=2)
    return found


def routable(points: DataFrame, what: str = "origin") -> DataFrame:
    """The points with both coordinates; a warning tells how many were dropped."""
    dropped = points.where("lon is null or lat is null").count()
    if dropped:
        warnings.warn(f"{dropped} {what}(s) without coordinates", stacklevel=2)
    return points.dropna("any", subset=["lon", "lat"])


def warn_strip_only(universe: DataFrame) -> DataFrame:
    """strip_only_types, with a warning that names up to ten of them."""
    types = strip_only_types(universe)
    some = [r[0] for r in types.orderBy("TYPEQU").limit(11).collect()]
    if some:
        warnings.warn(f"types of the strip only: {', '.join(some[:10])}{' and more' if len(some) > 10 else ''}", stacklevel=2)
    return types


def address_points_from_wkt(rows: DataFrame, strict: bool = True) -> DataFrame:
    """address_id, lon, lat of rows(address_id, wkt) in EPSG:2154, one per address.

    Empty geometry and unlike geometries of one address raise when strict, and
    are left out, or the first by coordinates kept, otherwise.
    """
    points = rows.select("address_id", wkt_centroid(F.col("wkt")).alias("c")).select("address_id", F.col("c.x").alias("x"), F.col("c.y").alias("y")).distinct()
    if strict:
        require_none(points.where("x is null or y is null").select("address_id"), "address without geometry")
        require_unique(points, ["address_id"], "address geometries")
    points = points.where("x is not null and y is not null").groupBy("address_id").agg(F.min(F.struct("x", "y")).alias("p"))
    return points.select("address_id", lambert93_to_wgs84(F.col("p.x"), F.col("p.y")).alias("w")).select("address_id", "w.lon", "w.lat")


def one_feature(layer: DataFrame, column: str, code: str) -> DataFrame:
    """The feature of a layer with a code; none or several raise."""
    found = layer.where(F.col(column) == code)
    n = found.limit(2).count()
    if n != 1:
        raise ContractError(f"expected one feature with {column} {code}, got {'several' if n else 'none'}")
    return found


def region_universe(equipment: DataFrame, edges: DataFrame, departements, width: float = BORDER_WIDTH_M) -> DataFrame:
    """equipment_universe with distance_m from the region's edges (operators.region), of any number of vertices, rings and holes."""
    located = region_distance(equipment.withColumns({c: F.col(c).cast("double") for c in ("LONGITUDE", "LATITUDE")}), edges, width, "LONGITUDE", "LATITUDE")
    return equipment_universe(located, F.col("distance_m"), departements, width)


def address_universe(origins: DataFrame, links: DataFrame, address_points: DataFrame, existing_points: DataFrame, strict: bool = False) -> DataFrame:
    """Addresses of eligible constructions: coordinates, counts, and whether a routed point already stands there.

    Unknown eligibility is refused; the eligible addresses are the left side
    throughout, so the national address table is only reduced, never kept.
    """
    require(origins, ["origin_id", "batiment_groupe_id", "is_dependance_candidate"], "origins")
    eligible = origins.where(~F.coalesce("is_dependance_candidate", F.lit(True))).select("origin_id", "batiment_groupe_id")
    relation = links.where("origin_id is not null and address_id is not null and address_id <> ''").select("origin_id", "address_id").distinct().join(eligible, "origin_id")
    counts = relation.groupBy("address_id").agg(F.count_distinct("origin_id").alias("n_non_dependance_constructions"), F.count_distinct("batiment_groupe_id").alias("n_residential_groups"))
    points = address_points.select("address_id", "lon", "lat").join(counts.select("address_id"), "address_id", "left_semi").distinct()
    if strict:
        require_unique(points, ["address_id"], "address points")
    rows = counts.join(points, "address_id", "left")
    known = existing_points.select(F.col("id").alias("routing_point_id"), "lon", "lat")
    rows = rows.join(known, ["lon", "lat"], "left")
    return rows.withColumn("routing_source", F.when(F.col("routing_point_id").isNotNull(), "existing").otherwise("reroute")).select("address_id", "lon", "lat", "n_non_dependance_constructions", "n_residential_groups", "routing_source", "routing_point_id")


def territory_crosswalk(addresses: DataFrame, links: DataFrame, origins: DataFrame, resolution: str = "error", strict: bool = False) -> DataFrame:
    """address_id, code_insee, code_departement.

    An address linked to several communes takes, with resolution "prefix", the
    one that its id starts with; unresolved conflicts raise when strict and are
    null otherwise.
    """
    located = links.join(origins.select("origin_id", F.col("code_commune_insee").alias("code_insee"), F.col("code_departement_insee").alias("code_departement")), "origin_id", "left")
    located = located.join(addresses.select("address_id"), "address_id", "left_semi")
    if strict:
        require_none(located.where("code_insee is null or code_departement is null").select("address_id"), "address without a territory")
    by = located.groupBy("address_id").agg(F.count_distinct("code_insee").alias("n"), F.min("code_insee").alias("code"), F.min("code_departement").alias("dep"), F.min(F.when(F.col("code_insee") == F.substring("address_id", 1, 5), F.struct("code_insee", "code_departement"))).alias("own"))
    use_prefix = F.lit(resolution == "prefix")
    out = by.select(
        "address_id", F.when(F.col("n") <= 1, F.col("code")).when(use_prefix, F.col("own.code_insee")).alias("code_insee"), F.when(F.col("n") <= 1, F.col("dep")).when(use_prefix, F.col("own.code_departement")).alias("code_departement")
    )
    if strict:
        require_none(out.where("code_insee is null").select("address_id"), "unresolved territory conflict")
    return out


def commune_crosswalk(communes: DataFrame, departements=None, strict: bool = False) -> DataFrame:
    """Commune codes with names and territories; an empty body code is null."""
    rows = communes.select("code_insee", F.col("nom_officiel").alias("nom_commune"), F.col("code_insee_du_departement").alias("code_departement"), F.col("code_insee_de_la_region").alias("region"), F.nullif(F.col("codes_siren_des_epci"), F.lit("")).alias("epci"))
    if departements:
        rows = rows.where(F.col("code_departement").isin(*departements))
    if strict:
        require_unique(rows, ["code_insee"], "communes")
    return rows


def communes_of_body(communes: DataFrame, siren: str) -> DataFrame:
    """Communes whose (multi-valued) body code contains siren."""
    return communes.where(F.coalesce(F.col("codes_siren_des_epci").contains(siren), F.lit(False)))


def territory_names(crosswalk: DataFrame, names: dict[str, DataFrame], strict: bool = False) -> DataFrame:
    """The crosswalk with nom_<level> of each lookup(code, nom); repeated codes and codes without a name raise when strict."""
    for level, lookup in names.items():
        if strict:
            require_unique(lookup, ["code"], f"names of {level}")
            require_none(lookup.where("code is null or nom is null or nom = ''").select("code"), f"{level} without a name")
        key = {"epci": "epci", "departement": "code_departement", "region": "region"}[level]
        crosswalk = crosswalk.join(lookup.select(F.col("code").alias(key), F.col("nom").alias(f"nom_{level}")), key, "left")
    return crosswalk
