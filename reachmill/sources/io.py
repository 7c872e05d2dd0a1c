"""Sources and sinks: tables, delimited files, archives, documents, atomic writes."""

from __future__ import annotations

import hashlib
import io
import json
import os
import re
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reachmill.functions.contracts import ContractError, require_unique


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, lazily; a missing path raises when it is read."""
    return spark.read.parquet(path)


def metric_columns(df: DataFrame, pattern: str = r"^(count_\d+_(walk|bike|car)|transit_gain_count_\d+_p1)$") -> list[str]:
    """Columns of a lazy table that are metrics, by name."""
    return [c for c in df.columns if re.search(pattern, c)]


def read_delimited(spark: SparkSession, paths, columns, sep: str = ",") -> DataFrame:
    """Delimited files with a header as text, so that codes keep their zeros; the same columns of each, in one table.

    A file without one of the columns is an error.
    """
    out = None
    for path in [paths] if isinstance(paths, str) else paths:
        df = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
        missing = [c for c in columns if c not in df.columns]
        if missing:
            raise ContractError(f"{path}: missing column(s) {', '.join(missing)}")
        df = df.select(*columns)
        out = df if out is None else out.unionByName(df)
    return out


def read_nomenclature(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    names = read_delimited(spark, path, ["TYPEQU", "LIB"], sep).withColumnRenamed("LIB", "nom_typequ")
    if names.where("TYPEQU is null or nom_typequ is null or TYPEQU = ''").limit(1).count():
        raise ContractError("nomenclature: empty code or label")
    require_unique(names, ["TYPEQU"], "nomenclature")
    return names


def read_snapshot(spark: SparkSession, path: str, columns, codes=None, key: str = "code_insee") -> DataFrame:
    """The frozen snapshot: five-character codes, doubles, optionally some communes only."""
    rows = read_delimited(spark, path, [key, "nom_commune", *columns])
    rows = rows.withColumn(key, F.when(F.length(key) < 5, F.lpad(key, 5, "0")).otherwise(F.col(key))).select(key, "nom_commune", *[F.col(c).try_cast("double").alias(c) for c in columns])
    return rows.where(F.col(key).isin(*codes)) if codes is not None else rows


# The columns of the equipment table that are read, all as text but the coordinates.
EQUIPMENT_COLUMNS = ["AN", "DEP", "DEPCOM", "LIBCOM", "TYPEQU", "SIRET", "NOMRS", "STATUT_DIFFUSION", "LIBVOIE", "QUALITE_GEOLOC", "QUALITE_XY", "LONGITUDE", "LATITUDE", "LAMBERT_X", "LAMBERT_Y", "EPSG", "EPCI"]


def read_equipment(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """The equipment table: its 17 columns of many, codes as text, coordinates as doubles."""
    rows = read_delimited(spark, path, EQUIPMENT_COLUMNS, sep)
    numbers = ("LONGITUDE", "LATITUDE", "LAMBERT_X", "LAMBERT_Y")
    return rows.select(*[F.col(c).try_cast("double").alias(c) if c in numbers else F.col(c) for c in EQUIPMENT_COLUMNS])


def read_codes(spark: SparkSession, path: str) -> list[str]:
    """The first column of a short delimited file."""
    return [r[0] for r in spark.read.option("header", True).csv(path).collect()]


def chunk_of_file(column="_metadata.file_name"):
    """mode and chunk number of a row's file name <mode>_<chunk>.parquet."""
    name = F.col(column)
    return F.regexp_extract(name, r"^([a-z_]+?)_(\d+)\.parquet$", 1).alias("mode"), F.regexp_extract(name, r"^([a-z_]+?)_(\d+)\.parquet$", 2).try_cast("int").alias("chunk_id")


def write_chunks(rows: DataFrame, path: str, mode: str | None = None, chunk_id: int | None = None) -> None:
    """Rows by mode and chunk; a chunk that is there already is replaced as a whole by the commit."""
    if mode is not None:
        rows = rows.withColumn("mode", F.lit(mode))
    if chunk_id is not None:
        rows = rows.withColumn("chunk_id", F.lit(chunk_id))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").option("parquet.block.row.count.limit", 65536)
    writer.partitionBy("mode", "chunk_id").parquet(path)


def write_pairs(pairs: DataFrame, path: str, mode: str, chunk_id: int, run_label: str, transit: bool = False) -> None:
    """The raw pairs of a chunk with their duplicates; a transit chunk needs both percentiles."""
    needed = ["from_id", "to_id", *(["travel_time_p1", "travel_time_p50"] if transit else ["travel_time"])]
    missing = [c for c in needed if c not in pairs.columns]
    if missing:
        raise ContractError(f"pairs: missing column(s) {', '.join(missing)}")
    typed = pairs.select(*[F.col(c).cast("string" if c.endswith("_id") else "double").alias(c) for c in needed], F.lit(run_label).alias("run_label"))
    write_chunks(typed, path, mode, chunk_id)


def write_table(df: DataFrame, path: str, order=None) -> None:
    """A table, in byte order of the columns ``order`` over all its files if given."""
    df = df.orderBy(*order) if order else df
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_checkpoint(rows: DataFrame, path: str, name: str) -> None:
    """One part of a set of tables with one schema; a part that is there already is replaced."""
    write_table(rows, os.path.join(path, f"part={name}"))


def read_checkpoint(spark: SparkSession, path: str, key, names=None) -> DataFrame:
    """The parts (the named ones) as one table; a key that occurs twice raises."""
    rows = spark.read.parquet(path)
    if names is not None:
        rows = rows.where(F.col("part").isin(*names))
    require_unique(rows, list(key), "checkpoint")
    return rows.drop("part")


def write_poly(rings, path: str, name: str = "crop") -> None:
    """Rings of (lon, lat) as a polygon filter file: a name, numbered rings closed by END, and END."""
    lines = [name]
    for i, ring in enumerate(rings, 1):
        ring = [*ring, ring[0]] if ring[0] != ring[-1] else ring
        lines += [str(i), *[f"   {x:.7E}   {y:.7E}" for x, y in ring], "END"]
    part = f"{path}.{os.getpid()}.part"
    with open(part, "w", encoding="ascii") as f:
        f.write("\n".join([*lines, "END"]) + "\n")
    os.replace(part, path)


def write_json(value, path: str) -> None:
    """A document by a temporary file and a rename."""
    part = f"{path}.{os.getpid()}.part"
    with open(part, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, sort_keys=True, ensure_ascii=False)
        f.write("\n")
    os.replace(part, path)


def read_json(path: str, kind: str | None = None):
    with open(path, encoding="utf-8") as f:
        value = json.load(f)
    if kind is not None and value.get("kind") != kind:
        raise ContractError(f"{path}: not a {kind} document")
    return value


def sha256_file(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def cached(spark: SparkSession, folder: str, key: dict, make) -> DataFrame:
    """The table that make() gives, kept under a digest of its key."""
    digest = hashlib.sha256(json.dumps(key, sort_keys=True).encode()).hexdigest()[:24]
    path = os.path.join(folder, digest)
    if not os.path.exists(os.path.join(path, "_SUCCESS")):
        write_table(make(), path)
    return spark.read.parquet(path)


def _member(data: bytes, member: str, required: bool):
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = [n for n in z.namelist() if os.path.basename(n).lower() == member.lower()]
        if len(names) > 1:
            raise ContractError(f"member {member} occurs {len(names)} times")
        if not names:
            if required:
                raise ContractError(f"member {member} is missing")
            return None
        return z.read(names[0])


def read_zip_member(spark: SparkSession, path: str, member: str, required: bool = True) -> DataFrame | None:
    """A delimited member of an archive as text columns; empty and NA are null, a leading mark is dropped.

    One archive of a timetable is one small file, so it is opened on the driver;
    archives are read through Spark, so any store will do.
    """
    import csv

    data = spark.read.format("binaryFile").load(path).select("content").first()
    raw = _member(bytes(data[0]), member, required)
    if raw is None:
        return None
    rows = list(csv.reader(io.StringIO(raw.decode("utf-8-sig"))))
    header = [c.strip() for c in rows[0]]
    clean = [[None if v in ("", "NA") else v for v in (r + [""] * len(header))[: len(header)]] for r in rows[1:] if r]
    return spark.createDataFrame(clean, ", ".join(f"`{c}` string" for c in header))


def write_zip(members: dict[str, bytes], path: str) -> None:
    """An archive that depends on its members only: sorted names, one fixed time."""
    part = f"{path}.part"
    with zipfile.ZipFile(part, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(members):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.compress_type = zipfile.ZIP_DEFLATED
            z.writestr(info, members[name])
    os.replace(part, path)


def check_timetable_zip(path: str, required=("stops.txt", "trips.txt", "stop_times.txt", "routes.txt")) -> None:
    with zipfile.ZipFile(path) as z:
        sizes = {os.path.basename(i.filename).lower(): i.file_size for i in z.infolist()}
    bad = [m for m in required if not sizes.get(m)]
    if bad:
        raise ContractError(f"{path}: missing or empty {', '.join(bad)}")


def acquire(url: str, folder: str, sha256: str | None = None) -> str:
    """The local copy of a file, fetched once and checked against its digest before it is kept."""
    import urllib.request

    target = os.path.join(folder, os.path.basename(url))
    if not os.path.exists(target):
        part = f"{target}.part"
        with urllib.request.urlopen(url) as source, open(part, "wb") as out:
            while block := source.read(1 << 20):
                out.write(block)
        if sha256 and sha256_file(part) != sha256:
            os.remove(part)
            raise ContractError(f"{url}: digest differs")
        os.replace(part, target)
    elif sha256 and sha256_file(target) != sha256:
        raise ContractError(f"{target}: digest differs")
    return target
