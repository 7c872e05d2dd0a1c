"""Coordinates, routing once per coordinate, and expansion to identities."""

from __future__ import annotations

import datetime
import hashlib
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import CAP, MODES, ContractError, assert_within_cap, require_none
from reachmill.operators.joins import blocks, fanned, sliced
from reachmill.operators.ranking import numbered
from reachmill.sources.lineage import cut


#: Pairs of origins and destinations in neighbouring cells that one task meets, about.
PAIRS_A_TASK = 5_000_000


class Router(Protocol):
    """Anything that turns origins(id, lon, lat) and destinations(id, lon, lat) into pairs(from_id, to_id, travel_time)."""

    def __call__(self, origins: DataFrame, destinations: DataFrame) -> DataFrame: ...


def coordinate_plan(points: DataFrame, prefix: str, order: str = "ord") -> tuple[DataFrame, DataFrame]:
    """(points(id, lon, lat), link(id, point_id)): one routed point per exact coordinate, numbered by first appearance.

    Only the distinct coordinates are numbered, not the identities.
    """
    first = points.groupBy("lon", "lat").agg(F.min(order).alias("first"))
    planned = numbered(first, "first", "number")
    planned = planned.select("lon", "lat", F.format_string(f"{prefix}_%06d", "number").alias("point_id"))
    link = points.join(planned, ["lon", "lat"]).select("id", "point_id")
    return planned.select(F.col("point_id").alias("id"), "lon", "lat"), link


def expand_pairs(pairs: DataFrame, origin_link: DataFrame, destination_link: DataFrame, strict: bool = False) -> DataFrame:
    """Pairs of coordinates to pairs of identities, however many share a coordinate; ids unknown to a link raise when strict."""
    if strict:
        require_none(pairs.join(origin_link.select(F.col("point_id").alias("from_id")), "from_id", "left_anti").select("from_id"), "unknown origin point")
        require_none(pairs.join(destination_link.select(F.col("point_id").alias("to_id")), "to_id", "left_anti").select("to_id"), "unknown destination point")
    rest = [c for c in pairs.columns if c not in ("from_id", "to_id")]
    o = blocks(origin_link.select(F.col("point_id").alias("from_id"), F.col("id").alias("origin")), ["from_id"], "_origins")
    d = blocks(destination_link.select(F.col("point_id").alias("to_id"), F.col("id").alias("destination")), ["to_id"], "_destinations").drop("_part")
    copies = o.groupBy("from_id").agg(F.max("_part").alias("_last")).where("_last > 0")  # of the pairs of hot points alone
    met = pairs.join(d, "to_id").join(copies, "from_id", "left").withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_last", F.lit(0))))).drop("_last")
    met = fanned(sliced(met, "_destinations"), "from_id", "_part").join(fanned(sliced(o, "_origins"), "from_id", "_part"), ["from_id", "_part"])
    return _each(met, rest)


def _each(met: DataFrame, rest) -> DataFrame:
    """A row for each of _origins with each of _destinations, which stay runs of blocks until here."""
    rows = met.select(F.explode("_origins").alias("o"), "_destinations", *rest)
    return rows.select("o", F.explode("_destinations").alias("d"), *rest).select(F.col("o.origin").alias("from_id"), F.col("d.destination").alias("to_id"), *rest)


def stub_route(origins: DataFrame, destinations: DataFrame, cap: float = CAP, base_minutes: float = 2, km_per_degree=(80.0, 111.0), speed_kmh: float = 30.0) -> DataFrame:
    """Planar travel times within the cap: base + ceil(distance / speed).

    The cap bounds the distance, so destinations are met through cells of that
    width (a cell and its neighbours) and not through all pairs.  What meets are
    coordinates with the ids that stand there, so a time is found once for a
    pair of coordinates.  A cell is dealt to several tasks by its number of pairs.
    """
    assert_within_cap(cap)
    reach = (cap - base_minutes) * speed_kmh / 60
    x, y = lambda c: F.floor(F.col(c) * km_per_degree[0] / reach), lambda c: F.floor(F.col(c) * km_per_degree[1] / reach)
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    d = blocks(destinations.select(F.col("lon").alias("dx"), F.col("lat").alias("dy"), F.col("id").alias("destination")), ["dx", "dy"], "_destinations")
    d = d.select("dx", "dy", "_destinations", x("dx").alias("cx"), y("dy").alias("cy"))
    o = blocks(origins.select("lon", "lat", F.col("id").alias("origin")), ["lon", "lat"], "_origins").select("lon", "lat", "_part", "_origins", x("lon").alias("ox"), y("lat").alias("oy"))
    around = lambda df: df.withColumn("i", F.explode(near)).withColumn("j", F.explode(near)).withColumn("cx", F.col("ox") + F.col("i")).withColumn("cy", F.col("oy") + F.col("j"))
    sizes = lambda df, a, b, n: df.groupBy(a.alias("cx"), b.alias("cy")).agg(F.count("*").alias(n))
    own = sizes(origins, x("lon"), y("lat"), "n_o").withColumnsRenamed({"cx": "ox", "cy": "oy"})
    work = around(own).groupBy("cx", "cy").agg(F.sum("n_o").alias("n_o")).join(sizes(destinations, x("lon"), y("lat"), "n_d"), ["cx", "cy"])
    tasks = int(origins.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = work.select("cx", "cy", F.least(F.lit(tasks), F.ceil(F.col("n_o").cast("double") * F.col("n_d") / PAIRS_A_TASK)).cast("int").alias("parts"))
    of_part = F.pmod(F.xxhash64("lon", "lat", "_part"), "parts").alias("part")
    o = around(o).join(parts, ["cx", "cy"]).select("cx", "cy", of_part, "lon", "lat", "_origins")
    d = d.join(parts, ["cx", "cy"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    east, north = (F.col("lon") - F.col("dx")) * km_per_degree[0], (F.col("lat") - F.col("dy")) * km_per_degree[1]
    minutes = base_minutes + F.ceil(F.sqrt(east * east + north * north) / speed_kmh * 60)
    met = fanned(sliced(o, "_origins"), "cx", "cy", "part").join(fanned(sliced(d, "_destinations"), "cx", "cy", "part"), ["cx", "cy", "part"])
    return _each(met.withColumn("travel_time", minutes.cast("double")).where(F.col("travel_time") <= cap), ["travel_time"])


#: Kilometres an hour of the modes that go at a speed of their own; the car's is that of the stub.
SPEEDS = {"walk": 4.0, "bike": 12.0, "car": 30.0}


def probe_modes(modes, departure=None) -> list[str]:
    """The modes, if all are known and transit has an instant of departure (with a time, not a date alone)."""
    unknown = [m for m in modes if m not in MODES]
    if unknown or not modes:
        raise ContractError(f"unknown mode(s) {', '.join(unknown)}" if unknown else "no mode")
    if "transit" in modes and not isinstance(departure, datetime.datetime):
        raise ContractError("transit needs an instant of departure")
    return list(modes)


def stub_dispatch(origins: DataFrame, destinations: DataFrame, cap: float = CAP, mode: str = "car", departure=None, speeds=None) -> DataFrame:
    """The stub's pairs of a mode: planar times at the mode's speed, and both percentiles for transit."""
    probe_modes([mode], departure)
    if mode == "transit":
        return stub_transit_route(origins, destinations, cap=cap)
    return stub_route(origins, destinations, cap=cap, speed_kmh=(speeds or SPEEDS)[mode])


def stub_transit_route(origins: DataFrame, destinations: DataFrame, **how) -> DataFrame:
    pairs = stub_route(origins, destinations, **how)
    return pairs.select("from_id", "to_id", F.col("travel_time").alias("travel_time_p1"), (F.col("travel_time") + 5).alias("travel_time_p50"))


def route_unique(origins: DataFrame, destinations: DataFrame, router: Router, order: str = "ord") -> DataFrame:
    """Routes every distinct coordinate once and expands the result to identities."""
    op, ol = coordinate_plan(origins, "coord_o", order)
    dp, dl = coordinate_plan(destinations, "coord_d", order)
    return expand_pairs(router(op, dp), ol, dl)


def chunk_ids(points: DataFrame, size: int, order: str = "id") -> DataFrame:
    """points with chunk_id from 1: consecutive runs of ``size`` in plan order."""
    return numbered(points, order, "_number").withColumn("chunk_id", (F.floor((F.col("_number") - 1) / size) + 1).cast("int")).drop("_number")


def chunk_slice(points: DataFrame, chunk_id: int, size: int, order: str = "id") -> DataFrame:
    """The points of one chunk, numbers (chunk_id - 1) * size + 1 to chunk_id * size; a chunk that is not there raises."""
    found = chunk_ids(points, size, order).where(F.col("chunk_id") == chunk_id).drop("chunk_id")
    if not found.limit(1).count():
        raise ContractError(f"there is no chunk {chunk_id}")
    return found


def census(identities: DataFrame, points: DataFrame, size: int) -> DataFrame:
    """n_identities, n_coordinates, n_chunks; more coordinates than identities, or none for some, raise when the result is made."""
    a, b = identities.agg(F.count("*").alias("n_identities")), points.agg(F.count("*").alias("n_coordinates"))
    possible = (F.col("n_coordinates") <= F.col("n_identities")) & ((F.col("n_coordinates") > 0) | (F.col("n_identities") == 0))
    coordinates = F.when(possible, F.col("n_coordinates")).otherwise(F.raise_error(F.lit("census: impossible number of coordinates")).cast("long"))
    return a.join(b).select("n_identities", coordinates.alias("n_coordinates"), F.ceil(F.col("n_coordinates") / size).alias("n_chunks"))


def table_fingerprint(table: DataFrame, columns=None) -> DataFrame:
    """content_key: a digest of a table that depends on neither the order of its rows nor that of its columns.

    A row's line holds the named columns (all, if None are) in order of name, each as
    its name and its text, with null told from the empty text.
    """
    names = sorted(columns or table.columns)
    parts = [F.concat(F.lit(f"{c}="), F.coalesce(F.concat(F.lit("'"), F.col(c).cast("string")), F.lit("-"))) for c in names]
    return _set_digest(table.select(F.sha2(F.concat_ws("|", *parts), 256).alias("h")))


def plan_key(tables: dict[str, DataFrame]) -> str:
    """One digest of several tables by name."""
    lines = [f"{name}={table_fingerprint(df).first()[0]}" for name, df in sorted(tables.items())]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def universe_key(points: DataFrame) -> DataFrame:
    """content_key: a digest of the rows (id, lon, lat) that doesn't depend on their order."""
    line = F.sha2(F.concat_ws("|", "id", F.col("lon").cast("string"), F.col("lat").cast("string")), 256)
    return _set_digest(points.select(line.alias("h")))


#: Lines of a leaf, about, as long as there are no more than 256 leaves.
CHILDREN = 256
#: Hexadecimal digits of the longest prefix that makes a leaf: part of the key's definition, so no number of rows makes it longer.
PREFIX = 2


def _leaves(batches):
    """h, n: the digest of the lines (prefix, h, n) of each prefix, which follow each other in order of h and are hashed batch by batch."""
    import pyarrow as pa
    import pyarrow.compute as pc

    node, sha, found = None, None, []
    for batch in batches:
        prefixes, h, n = batch.columns
        lines, runs = pc.binary_join_element_wise(h, pc.cast(n, pa.string()), ":").to_pylist(), pc.run_end_encode(prefixes)
        at = 0
        for prefix, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
            text = ",".join(lines[at:end])
            if sha is None or prefix != node:
                if sha:
                    found.append((node, sha.hexdigest()))
                node, sha = prefix, hashlib.sha256(text.encode())
            else:
                sha.update(f",{text}".encode())
            at = end
    if sha:
        found.append((node, sha.hexdigest()))
    yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.string()) for i in (0, 1)], names=["h", "n"])


def _set_digest(lines: DataFrame) -> DataFrame:
    """content_key of the digests h, equal ones counted: SHA-256 of leaves, and of these together.

    A leaf hashes the sorted lines h:count whose digests share a prefix of none to
    PREFIX digits, so many that about CHILDREN lines are left if that many do.
    The root hashes the leaves as prefix:digest.  Lines are hashed as they come, so a leaf may have any number of them.
    """
    counted = cut(lines.groupBy("h").agg(F.count("*").alias("n")))
    total, length = counted.count(), 0
    while total > CHILDREN * 16**length and length < PREFIX:
        length += 1
    rows = counted.select(F.substring("h", 1, length).alias("prefix"), "h", "n")
    nodes = rows.repartition("prefix").sortWithinPartitions("h").mapInArrow(_leaves, "h string, n string")
    line = F.concat("h", F.lit(":"), "n")
    return nodes.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(line)), ","), 256).alias("content_key"))
