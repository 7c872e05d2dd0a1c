"""The wide address table: normalise families, project to addresses, merge with conflict checks, finish."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import ATOMIC, MONOLITH_KEY, RUNGS, ContractError, atomic_count_columns, gain_columns, monolith_gain_columns, nearest_columns, require, require_none
from reachmill.operators.joins import fan_out
from reachmill.sources.stored import StoredTable


def normalise_atomic(rows: DataFrame, mode: str, strict: bool = False) -> DataFrame:
    """tt_nearest and count_r under the mode's names; rows of another mode raise when strict, transit is refused."""
    if mode not in ATOMIC:
        raise ContractError(f"{mode} is no atomic mode of the address table")
    if strict:
        require_none(rows.where(~F.col("mode").eqNullSafe(mode)).select("mode"), f"rows of another mode than {mode}")
    names = {"tt_nearest": f"nearest_{mode}", **{f"count_{r}": f"count_{r}_{mode}" for r in RUNGS}}
    keys = [c for c in rows.columns if c not in {"mode", *names}]
    return rows.select(*keys, *[F.col(a).alias(b) for a, b in names.items()])


def normalise_gains(rows: DataFrame) -> DataFrame:
    """Gain columns under their names in the address table."""
    named = {c: "transit_gain_walk_available" if c == "walk_available" else re.sub(r"^(time|count)_gain_", r"transit_gain_\1_", c) for c in gain_columns()}
    return rows.withColumnsRenamed({a: b for a, b in named.items() if a in rows.columns}).drop("mode")


def publish_names(columns) -> dict[str, str]:
    """Renaming of statistic columns of gains: the rung first, the family last."""
    return {c: re.sub(r"^transit_gain_count_(\d+)_p1_(.+)$", r"count_\1_transitgain_\2", c) for c in columns}


def conflicts(rows: DataFrame, key) -> DataFrame:
    """Keys whose rows are not all equal; null against a value counts as a difference."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.count_distinct(F.struct(*rest)).alias("n_versions")).where("n_versions > 1")


def single_values(rows: DataFrame, key, column: str, strict: bool = True) -> DataFrame:
    """key and the one value of a column that is present for it, null without any; several values raise when strict."""
    out = rows.groupBy(*key).agg(F.max(column).alias(column), (F.min(column) != F.max(column)).alias("_clash"))
    if strict:
        require_none(out.where("_clash").select(*key), f"several values of {column}")
    return out.drop("_clash")


def collapse(rows: DataFrame, key=tuple(MONOLITH_KEY), strict: bool = False) -> DataFrame:
    """One row per key.  Rows of a key must be equal (raises when strict)."""
    key = list(key)
    if strict:
        require_none(conflicts(rows, key), "conflicting duplicates")
    return rows.dropDuplicates()


def merge(sides: list[DataFrame], key=tuple(MONOLITH_KEY), strict: bool = False) -> DataFrame:
    """Upsert of any number of row sets: a value, where one is given, wins over null; two different values raise when strict.

    One union and one aggregation, whatever the number of sides.  Gain columns
    that disagree on walk_available are taken from the rows that also have a
    walking time, if these agree.
    """
    key, columns, types = list(key), [], {}
    for side in sides:
        for c, t in side.dtypes:
            if c not in types:
                columns.append(c)
                types[c] = t
    full = [s.select(*[F.col(c) if c in s.columns else F.lit(None).cast(types[c]).alias(c) for c in columns]) for s in sides]
    rows = full[0]
    for s in full[1:]:
        rows = rows.unionByName(s)
    return _fold(rows, key, columns, strict)


def _fold(rows, key, columns, strict):
    flag, gains = "transit_gain_walk_available", [c for c in monolith_gain_columns() if c in columns]
    aggregates, checks = [], []
    walked = F.col("nearest_walk").isNotNull() if "nearest_walk" in columns else F.lit(True)
    for c in columns:
        if c in key:
            continue
        if c in gains and flag in columns:
            split = (F.min(flag) != F.max(flag)) & F.max(F.when(F.col(flag).isNotNull(), walked))
            split = F.coalesce(split, F.lit(False))
            chosen = F.when(walked, F.col(c))
            aggregates.append(F.when(split, F.max(chosen)).otherwise(F.max(c)).alias(c))
            checks.append(F.coalesce(F.when(split, F.min(chosen) != F.max(chosen)).otherwise(F.min(c) != F.max(c)), F.lit(False)))
        else:
            aggregates.append(F.max(c).alias(c))
            checks.append(F.coalesce(F.min(c) != F.max(c), F.lit(False)))
    clash = checks[0]
    for x in checks[1:]:
        clash = clash | x
    out = rows.groupBy(*key).agg(*aggregates, clash.alias("_clash"))
    if strict:
        require_none(out.where("_clash").select(*key), "conflicting values")
    return out.select(*columns)


def upsert_stored(table: StoredTable, sides: list[DataFrame], strict: bool = True) -> int:
    """Merges families into a stored address table under the rules of merge, and returns the new version.

    Only the buckets of the incoming addresses are read and written.  With
    ``strict`` a value that differs from the stored one raises, and nothing is changed.
    """
    incoming = merge(sides, strict=strict)
    return table.upsert(incoming, lambda existing, new: merge([existing, new] if existing.columns else [new], strict=strict))


def merge_conflicts(sides: list[DataFrame], key=tuple(MONOLITH_KEY)) -> DataFrame:
    """key, column, n_values: where sides supply different values."""
    rows = sides[0]
    for s in sides[1:]:
        rows = rows.unionByName(s, allowMissingColumns=True)
    values = [c for c in rows.columns if c not in key]
    counts = rows.groupBy(*key).agg(*[F.count_distinct(c).alias(c) for c in values])
    return counts.unpivot(list(key), values, "column", "n_values").where("n_values > 1")


def project_base(matrix: DataFrame, origin_link: DataFrame, addresses: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of constructions to the addresses that stand on their routing point; collapsed per point before they fan out."""
    at_point = matrix.join(origin_link.select(F.col("id").alias("batiment_id"), "point_id"), "batiment_id").drop("batiment_id")
    at_point = collapse(at_point, ["point_id", "TYPEQU", *(["mode"] if "mode" in matrix.columns else [])], strict)
    existing = addresses.where("routing_source = 'existing'").select("address_id", F.col("routing_point_id").alias("point_id"))
    return fan_out(at_point, existing, "point_id").drop("point_id")


def project_reroute(rows: DataFrame, addresses: DataFrame, strict: bool = False) -> DataFrame:
    """Rerouted rows under their address ids; ids that are no rerouted address raise when strict."""
    own = addresses.where("routing_source = 'reroute'").select("address_id")
    named = rows.withColumnRenamed("batiment_id", "address_id")
    if strict:
        require_none(named.join(own, "address_id", "left_anti").select("address_id"), "not a rerouted address")
    return named.join(own, "address_id", "left_semi")


def finish(metrics: DataFrame, addresses: DataFrame, strict: bool = False) -> DataFrame:
    """The address table: attributes, every family's columns with absent counts as 0 and absent times as null."""
    require(addresses, ["address_id", "lon", "lat"], "addresses")
    if strict:
        require_none(metrics.join(addresses, "address_id", "left_anti").select("address_id"), "unknown address")
        require_none(addresses.where("lon is null or lat is null").select("address_id"), "address without coordinates")
    a = addresses.select("address_id", "lon", "lat", F.col("n_non_dependance_constructions").alias("n_linked_constructions"), F.col("n_residential_groups").alias("n_linked_groups"), "routing_source")
    rows = metrics.join(a, "address_id")
    has = lambda c: F.col(c) if c in metrics.columns else F.lit(None)
    out = ["address_id", "lon", "lat", "n_linked_constructions", "n_linked_groups", "routing_source", "TYPEQU"]
    out += [has(c).cast("double").alias(c) for c in nearest_columns()]
    out += [F.coalesce(has(c).cast("int"), F.lit(0)).alias(c) for c in atomic_count_columns()]
    out += [F.coalesce(has("transit_gain_walk_available").cast("boolean"), F.lit(False)).alias("transit_gain_walk_available")]
    out += [has(c).cast("double").alias(c) for c in monolith_gain_columns()[1:3]]
    out += [F.coalesce(has(c).cast("int"), F.lit(0)).alias(c) for c in monolith_gain_columns()[3:]]
    return rows.select(*out)


def build(atomic: dict[str, DataFrame], gains: DataFrame | None, origin_link: DataFrame, addresses: DataFrame, rerouted: dict[str, DataFrame] | None = None, strict: bool = False) -> DataFrame:
    """The whole build as one plan: normalise, project, merge, finish."""
    sides = [project_base(normalise_atomic(rows, mode, strict), origin_link, addresses, strict) for mode, rows in atomic.items()]
    if gains is not None:
        sides.append(project_base(normalise_gains(gains), origin_link, addresses, strict))
    sides += [project_reroute(normalise_atomic(rows, mode, strict), addresses, strict) for mode, rows in (rerouted or {}).items()]
    return finish(merge(sides, strict=strict), addresses, strict)


def widen(matrix: DataFrame) -> DataFrame:
    """batiment_id, TYPEQU and the columns of all atomic modes, from the rows of all modes in one aggregation."""
    of = lambda mode, c: F.max(F.when(F.col("mode") == mode, F.col(c)))
    rows = matrix.where(F.col("mode").isin(*ATOMIC)).groupBy("batiment_id", "TYPEQU")
    return rows.agg(*[of(m, "tt_nearest").alias(f"nearest_{m}") for m in ATOMIC], *[of(m, f"count_{r}").alias(f"count_{r}_{m}") for m in ATOMIC for r in RUNGS])


def with_gains(wide: DataFrame, transit: DataFrame) -> DataFrame:
    """The wide rows and those of the transit matrix alone, with the gains of transit over the walk of the same row."""
    t = transit.select("batiment_id", "TYPEQU", F.lit(True).alias("_t"), F.col("travel_time_p1").alias("_p1"), F.col("travel_time_p50").alias("_p50"), *[F.col(f"count_{r}{s}").alias(f"_{r}_{p}") for s, p in (("", "p1"), ("_p50", "p50")) for r in RUNGS])
    rows = wide.join(t, ["batiment_id", "TYPEQU"], "full")
    walk = F.col("nearest_walk")
    gains = [F.when(F.col("_t"), walk.isNotNull()).alias("transit_gain_walk_available"), *[(walk - F.col(f"_{p}")).alias(f"transit_gain_time_{p}") for p in ("p1", "p50")]]
    gains += [(F.col(f"_{r}_{p}") - F.coalesce(f"count_{r}_walk", F.lit(0))).cast("int").alias(f"transit_gain_count_{r}_{p}") for p in ("p1", "p50") for r in RUNGS]
    return rows.select(*wide.columns, *gains)


def build_wide(matrix: DataFrame, transit: DataFrame, origin_link: DataFrame, addresses: DataFrame, rerouted: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """What build gives, from the matrix of all modes and the transit matrix, each read once.

    Modes and gains are columns before anything is projected; rows of one
    routing point are folded there, before they fan out to its addresses.
    ``rerouted`` holds wide rows under their address ids.
    """
    rows = with_gains(widen(matrix), transit).join(origin_link.select(F.col("id").alias("batiment_id"), "point_id"), "batiment_id").drop("batiment_id")
    at_point = merge([rows], ["point_id", "TYPEQU"], strict)
    existing = addresses.where("routing_source = 'existing'").select("address_id", F.col("routing_point_id").alias("point_id"))
    out = fan_out(at_point, existing, "point_id").drop("point_id")
    if rerouted is not None:
        out = out.unionByName(project_reroute(rerouted, addresses, strict), allowMissingColumns=True)
    return finish(out, addresses, strict)


def base_point_ids(rows: DataFrame, origin_link: DataFrame, strict: bool = False) -> DataFrame:
    """The distinct routing points that rows(batiment_id) touch; an id without a link raises when strict."""
    link = origin_link.select(F.col("id").alias("batiment_id"), "point_id")
    ids = rows.select("batiment_id").distinct()
    if strict:
        require_none(ids.join(link, "batiment_id", "left_anti"), "no routing point")
    return ids.join(link, "batiment_id").select("point_id").distinct()


def points_in_several_chunks(rows: DataFrame) -> DataFrame:
    """point_id, n_chunks of routing points that more than one chunk touches."""
    return rows.groupBy("point_id").agg(F.count_distinct("chunk_id").alias("n_chunks")).where("n_chunks > 1")
