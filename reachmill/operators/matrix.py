"""Pairs to the sparse matrix, building metrics and territory aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reachmill.functions.contracts import ATOMIC, CLUSTERS, LEVELS, MODES, RUNGS, ContractError, require, require_none, require_unique
from reachmill.sources.lineage import cut

# Accepted spellings of the percentile columns, the first found wins.
P1_NAMES = ["travel_time_p1", "travel_time_p01", "travel_time_p001", "tt_p1", "p1"]
P50_NAMES = ["travel_time_p50", "tt_p50", "p50"]
#: Rows of points by types, some hundred bytes each, that are broadcast to all identities, at most.
FEW = 200_000


def percentile_column(names, percentile: int) -> str:
    found = next((n for n in (P1_NAMES if percentile == 1 else P50_NAMES) if n in names), None)
    if found is None:
        raise ContractError(f"no column for percentile {percentile}")
    return found


def collapse_pairs(pairs: DataFrame, keys=("from_id", "to_id")) -> DataFrame:
    """The smallest travel time of each pair."""
    return pairs.groupBy(*keys).agg(F.min("travel_time").alias("travel_time"))


def orient_pairs(pairs: DataFrame, origins: DataFrame, destinations: DataFrame) -> DataFrame:
    """Pairs with from_id among the origins and to_id among the destinations, both given as id; swapped if they came the other way round."""
    ends = pairs.select("from_id", "to_id")
    inside = lambda c, ids: not ends.join(ids.select(F.col("id").alias(c)), c, "left_anti").limit(1).count()
    if inside("from_id", origins) and inside("to_id", destinations):
        return pairs
    if inside("from_id", destinations) and inside("to_id", origins):
        rest = [c for c in pairs.columns if c not in ("from_id", "to_id")]
        return pairs.select(F.col("to_id").alias("from_id"), F.col("from_id").alias("to_id"), *rest).select(pairs.columns)
    raise ContractError("pairs are in neither orientation")


def _counts(column: str, suffix: str = ""):
    return [F.count_if(F.col(column) <= r).cast("int").alias(f"count_{r}{suffix}") for r in RUNGS]


def pair_views(pairs: DataFrame, keys=("from_id", "to_id")) -> tuple[DataFrame, DataFrame]:
    """The raw pairs and the collapsed ones."""
    return pairs, collapse_pairs(pairs, keys)


def derive_matrix(pairs: DataFrame, dest_map: DataFrame, mode: str | None = None, strict: bool = False, carry=()) -> DataFrame:
    """Nearest time and counts per rung of each (origin, type, mode); unmapped destinations are dropped.

    ``pairs`` holds one time per pair and, without ``mode``, a mode column.  The
    type map is joined by id; an id that it holds twice raises when strict.
    ``carry`` names columns of pairs that have one value for an origin and are kept.
    """
    if strict:
        require_unique(dest_map, ["id"], "destination types")
    rows = pairs if mode is None else pairs.withColumn("mode", F.lit(mode))
    typed = rows.join(dest_map.select(F.col("id").alias("to_id"), "TYPEQU"), "to_id")
    return typed.groupBy(F.col("from_id").alias("batiment_id"), "TYPEQU", "mode", *carry).agg(F.min("travel_time").alias("tt_nearest"), *_counts("travel_time"))


def derive_transit_matrix(pairs: DataFrame, dest_map: DataFrame, strict: bool = False, carry=()) -> DataFrame:
    """The transit matrix: rows with either percentile null are dropped, both minima are taken on their own, pairs are not collapsed first."""
    p1, p50 = percentile_column(pairs.columns, 1), percentile_column(pairs.columns, 50)
    rows = pairs.withColumnsRenamed({p1: "travel_time_p1", p50: "travel_time_p50"}).dropna("any", subset=["travel_time_p1", "travel_time_p50"])
    if strict:
        require_unique(dest_map, ["id"], "destination types")
        require_none(rows.where("travel_time_p1 > travel_time_p50"), "percentile 1 above percentile 50")
    typed = rows.join(dest_map.select(F.col("id").alias("to_id"), "TYPEQU"), "to_id")
    out = typed.groupBy(F.col("from_id").alias("batiment_id"), "TYPEQU", *carry).agg(
        F.min("travel_time_p1").alias("tt_nearest"), F.min("travel_time_p50").alias("travel_time_p50"), *_counts("travel_time_p1"), *_counts("travel_time_p50", "_p50")
    )
    return out.withColumn("mode", F.lit("transit")).withColumn("travel_time_p1", F.col("tt_nearest"))


def _classes(link: DataFrame, end: str, carry=()) -> tuple[DataFrame, DataFrame]:
    """(points(end, point_id), members(end, id)): identities that stand at the same points have one class, nearly always of one point.

    ``carry`` is part of the identity and of its class.  How often an identity stands at a point doesn't matter.
    """
    by = link.groupBy("id", *carry).agg(F.array_sort(F.collect_set("point_id")).alias("_at"))
    members = by.select(F.struct("_at", *carry).alias(end), "id")
    return members.select(end).distinct().select(end, F.explode(f"{end}._at").alias("point_id")), members


def _few(df: DataFrame) -> DataFrame:
    """df written once, and broadcast where it has few rows: what is joined with it stays as it was dealt."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= FEW else df


def _summed(rows: DataFrame, by, weight: str, times: dict) -> DataFrame:
    """The smallest of each time, and per rung the sum of ``weight`` of the rows within it; times: column to suffix of the counts."""
    within = lambda c, r: F.coalesce(F.sum(F.when(F.col(c) <= r, F.col(weight))), F.lit(0)).cast("int")
    return rows.groupBy(*by).agg(*[F.min(c).alias(c) for c in times], *[within(c, r).alias(f"count_{r}{s}") for c, s in times.items() for r in RUNGS])


def derive_shared_matrix(routed: DataFrame, link: DataFrame, dest_link: DataFrame, dest_map: DataFrame, mode: str, carry=()) -> DataFrame:
    """derive_matrix (or, for transit, derive_transit_matrix) of expand_pairs(routed, ...), without a row for each pair of identities.

    Destinations are counted by point and type, points are measured against
    these, and the result goes to all identities of a point, so work follows the
    pairs of points and the rows that come out.  ``carry`` names columns of ``link``.
    """
    types = dest_map.select("id", "TYPEQU")
    if mode == "transit":  # a pair counts as often as it occurs, so both links do too
        p1, p50 = percentile_column(routed.columns, 1), percentile_column(routed.columns, 50)
        times = {"travel_time_p1": "", "travel_time_p50": "_p50"}
        rows = routed.select("from_id", "to_id", F.col(p1).alias("travel_time_p1"), F.col(p50).alias("travel_time_p50")).dropna("any", subset=list(times))
        held = dest_link.join(types, "id").groupBy(F.col("point_id").alias("to_id"), "TYPEQU").agg(F.count("*").alias("_n"))
        at_point = _few(_summed(rows.join(held, "to_id"), ["from_id", "TYPEQU"], "_n", times))
        stands = link.select("id", *carry, F.col("point_id").alias("from_id"), F.count("*").over(Window.partitionBy("id", *carry)).alias("_places"))
        once, several = stands.where("_places = 1"), stands.where("_places > 1")
        counts = [f"count_{r}{s}" for s in times.values() for r in RUNGS]
        keys = [F.col("id").alias("batiment_id"), "TYPEQU", *carry]
        one = once.join(at_point, "from_id").select(*keys, *times, *counts)
        more = several.join(at_point, "from_id").groupBy(*keys).agg(*[F.min(c).alias(c) for c in times], *[F.sum(c).cast("int").alias(c) for c in counts])
        out = one.unionByName(more).withColumnRenamed("travel_time_p1", "tt_nearest")
        return out.withColumn("mode", F.lit("transit")).withColumn("travel_time_p1", F.col("tt_nearest"))
    (origins, members), (destinations, held) = _classes(link, "_o", carry), _classes(dest_link, "_d")
    rows = routed.join(origins.withColumnRenamed("point_id", "from_id"), "from_id").join(destinations.withColumnRenamed("point_id", "to_id"), "to_id")
    held = held.join(types, "id").groupBy("_d", "TYPEQU").agg(F.count("*").alias("_n"))
    at_class = _few(_summed(collapse_pairs(rows, ["_o", "_d"]).join(held, "_d"), ["_o", "TYPEQU"], "_n", {"travel_time": ""}))
    own = [F.col(f"_o.{c}").alias(c) for c in carry]
    return members.join(at_class, "_o").select(F.col("id").alias("batiment_id"), "TYPEQU", F.lit(mode).alias("mode"), *own, F.col("travel_time").alias("tt_nearest"), *[f"count_{r}" for r in RUNGS])


def building_metrics(matrix: DataFrame, kept, threshold: int = 20, ref_mode: str = "car", clusters=None, with_ref: bool = False, modes=None) -> DataFrame:
    """Diversity, total, loss against ref_mode and cluster flags of every building and mode of the whole matrix.

    A key occurs once, as validate_matrix demands.  One aggregation by building
    has a column for each mode, so the grid of buildings by modes needs no join.
    ``modes`` are those of the grid; without them they are looked up in the
    matrix, which reads its modes once more.  A row of another mode raises when
    the result is made.  ``with_ref`` adds the building's flags in ref_mode as
    ref_<cluster>.
    """
    if ref_mode not in ATOMIC:
        raise ContractError(f"the reference must be one of {', '.join(ATOMIC)}, not {ref_mode}")
    if threshold not in RUNGS or ref_mode not in MODES:
        raise ContractError("threshold must be a rung and ref_mode a mode")
    clusters, grid = clusters or CLUSTERS, tuple(modes or MODES)
    mode = F.coalesce("mode", F.lit("null"))
    checked = F.when(mode.isin(*grid), mode).otherwise(F.raise_error(F.concat(F.lit("building metrics: unknown mode "), mode)).cast("string"))
    typed = lambda types: F.coalesce(F.col("TYPEQU").isin(*types), F.lit(False))
    rows = matrix.select("batiment_id", checked.alias("mode"), F.when(typed(kept) & (F.col(f"count_{threshold}") >= 1), F.col(f"count_{threshold}")).alias("n"), *[typed(types).alias(name) for name, types in clusters.items()])
    of = lambda m, c: (F.col("mode") == m) & F.col("n").isNotNull() & c
    wide = rows.groupBy("batiment_id").agg(*[
        F.struct(F.lit(m).alias("mode"), F.count_if(of(m, F.lit(True))).alias("diversity"), F.coalesce(F.sum(F.when(F.col("mode") == m, F.col("n"))), F.lit(0)).cast("long").alias("total"),
                 *[F.coalesce(F.bool_or(of(m, F.col(name))), F.lit(False)).alias(f"has_{name}") for name in clusters]).alias(f"m_{m}")
        for m in dict.fromkeys([*grid, ref_mode])
    ])
    wide = wide.withColumn("v", F.array(*[f"m_{m}" for m in grid])).withColumn("ref", F.col(f"m_{ref_mode}"))
    known = F.lit(ref_mode in grid)
    if modes is None:
        present = rows.agg(F.collect_set("mode").alias("present"))  # one row of at most len(MODES) modes
        wide = wide.join(F.broadcast(present)).withColumn("v", F.filter("v", lambda x: F.array_contains("present", x["mode"])))
        known = F.array_contains("present", ref_mode)
    out = wide.select("batiment_id", F.explode("v").alias("v"), "ref", known.alias("known"))
    loss = lambda n: F.when(F.col("known"), F.col(f"ref.{n}") - F.col(f"v.{n}"))
    return out.select(
        "batiment_id", "v.mode", "v.diversity", "v.total", loss("diversity").alias("div_loss"), loss("total").alias("tot_loss"),
        *[F.col(f"v.has_{n}") for n in clusters], *[F.col(f"ref.has_{n}").alias(f"ref_{n}") for n in clusters if with_ref],
    )


def territory_aggregates(metrics: DataFrame, crosswalk: DataFrame, level: str, ref_mode: str = "car", clusters=None) -> DataFrame:
    """Shares, means and medians of building metrics by territory and mode.

    The flags of ref_mode are taken from the columns ref_<cluster> that
    building_metrics gives with_ref, and by a join of metrics with itself without them.
    """
    if level not in LEVELS:
        raise ContractError(f"level must be one of {', '.join(LEVELS)}")
    key, clusters = LEVELS[level][0], clusters or CLUSTERS
    located = metrics.join(crosswalk.select("batiment_id", key), "batiment_id").where(F.col(key).isNotNull())
    rows = located
    if not all(f"ref_{n}" in metrics.columns for n in clusters):
        ref = metrics.where(F.col("mode") == ref_mode).select("batiment_id", *[F.col(f"has_{n}").alias(f"ref_{n}") for n in clusters])
        rows = located.join(ref, "batiment_id", "left")
    share = lambda c: F.avg(c.cast("double"))
    return rows.groupBy(key, "mode").agg(
        F.count_distinct("batiment_id").alias("nb_buildings"),
        *[share(F.col(f"has_{n}")).alias(f"share_{n}") for n in clusters],
        *[share(F.coalesce(F.col(f"ref_{n}"), F.lit(False)) & ~F.col(f"has_{n}")).alias(f"pct_iso_{n}") for n in clusters],
        share(F.col("total") == 0).alias("pct_iso_full"), F.avg("diversity").alias("avg_diversity"), F.avg("total").alias("avg_total"),
        F.avg("div_loss").alias("avg_div_loss"), F.median(F.col("div_loss").cast("double")).alias("med_div_loss"), F.avg("tot_loss").alias("avg_tot_loss"), F.median(F.col("tot_loss").cast("double")).alias("med_tot_loss"),
    )


def transit_gains(transit: DataFrame, walk: DataFrame, strict: bool = False, carry=()) -> DataFrame:
    """Transit against walk: counts gained, minutes gained (null where walking does not reach), and whether it does.

    ``carry`` names columns of both that are part of the key and are kept.
    """
    require(transit, ["batiment_id", "TYPEQU", "travel_time_p1", "travel_time_p50"], "transit")
    if strict:
        require_unique(walk, ["batiment_id", "TYPEQU", *carry], "walk")
    side = walk.select("batiment_id", "TYPEQU", *carry, F.col("tt_nearest").alias("walk_tt"), *[F.col(f"count_{r}").alias(f"walk_{r}") for r in RUNGS])
    rows = transit.join(side, ["batiment_id", "TYPEQU", *carry], "left")
    gain = lambda r, s, p: (F.col(f"count_{r}{s}") - F.coalesce(F.col(f"walk_{r}"), F.lit(0))).cast("int").alias(f"count_gain_{r}_{p}")
    return rows.select(
        "batiment_id", "TYPEQU", F.lit("transit_gain").alias("mode"), F.col("walk_tt").isNotNull().alias("walk_available"),
        (F.col("walk_tt") - F.col("travel_time_p1")).alias("time_gain_p1"), (F.col("walk_tt") - F.col("travel_time_p50")).alias("time_gain_p50"),
        *[gain(r, "", "p1") for r in RUNGS], *[gain(r, "_p50", "p50") for r in RUNGS], *carry,
    )
