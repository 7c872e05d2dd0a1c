"""Layers of a geopackage as a data source: tasks read ranges of row ids, a few rows at a time.

The file is opened where the tasks run, so it lies in a folder that all of them
have mounted.  Only the columns that are asked for are read.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from reachmill.functions.contracts import ContractError

#: Rows of a task at most, and rows that are held at once.
PART_ROWS, HELD_ROWS = 20_000, 256


def wkb_to_wkt(blob: bytes) -> str:
    """Two-dimensional WKT of a geometry, with or without a geopackage header, of any kind; heights and measures are left out."""
    at = 8 + {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[blob[3] >> 1 & 7] if blob[:2] == b"GP" else 0
    kinds = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 5: "MULTILINESTRING", 6: "MULTIPOLYGON", 7: "GEOMETRYCOLLECTION"}

    def number(order, form):
        nonlocal at
        value = struct.unpack_from(order + form, blob, at)
        at += struct.calcsize(order + form)
        return value

    def points(order, n, size):
        found = [number(order, f"{size}d")[:2] for _ in range(n)]
        return ", ".join("{:.15g} {:.15g}".format(*p) for p in found if p[0] == p[0])  # an empty point holds no number

    def listed(parts):
        return "(" + ", ".join(parts) + ")" if parts else "EMPTY"

    def body():
        nonlocal at
        order = "<" if blob[at] else ">"
        at += 1
        (code,) = number(order, "I")
        size = 2 + (code >> 31 & 1) + (code >> 30 & 1) + {0: 0, 1: 1, 2: 1, 3: 2}[(code & 0xFFFF) // 1000]
        at += 4 * (code >> 29 & 1)
        kind = (code & 0xFFFF) % 1000
        if kind not in kinds:
            raise ContractError(f"geometry kind {kind} is not read")
        if kind == 1:
            text = points(order, 1, size)
            return kind, f"({text})" if text else "EMPTY"
        (n,) = number(order, "I")
        if kind == 2:
            return kind, f"({points(order, n, size)})" if n else "EMPTY"
        if kind == 3:
            return kind, listed([f"({points(order, *number(order, 'I'), size)})" for _ in range(n)])
        parts = [body() for _ in range(n)]
        return kind, listed([f"{kinds[k]} {text}" if kind == 7 else text for k, text in parts])

    kind, text = body()
    return f"{kinds[kind]} {text}"


class _Range(InputPartition):
    def __init__(self, first, last):
        super().__init__((first, last))
        self.first, self.last = first, last


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path, self.layer = options["path"], options["layer"]
        self.columns = [c for c in options["columns"].split("\x1f") if c]
        self.geometry = options.get("geometry")

    def _open(self):
        import sqlite3
        import urllib.parse

        return sqlite3.connect(f"file:{urllib.parse.quote(self.path)}?mode=ro&immutable=1", uri=True)

    def partitions(self):
        with self._open() as db:
            first, last = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.layer}"').fetchone()
        return [_Range(a, min(a + PART_ROWS - 1, last)) for a in range(first, last + 1, PART_ROWS)] if first is not None else [_Range(0, -1)]

    def read(self, partition):
        import pyarrow as pa

        names = [*self.columns, *([self.geometry] if self.geometry else [])]
        with self._open() as db:
            rows = db.execute("SELECT " + ", ".join(f'"{c}"' for c in names) + f' FROM "{self.layer}" WHERE rowid BETWEEN ? AND ? ORDER BY rowid', (partition.first, partition.last))
            while held := rows.fetchmany(HELD_ROWS):
                columns = [[None if v is None else str(v) for v in column] for column in list(zip(*held))[: len(self.columns)]]
                if self.geometry:
                    columns.append([wkb_to_wkt(r[-1]) if r[-1] else None for r in held])
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=names)


class GeopackageSource(DataSource):
    """format("geopackage_layer") with options path, layer, columns and, if geometry is wanted, its column."""

    @classmethod
    def name(cls):
        return "geopackage_layer"

    def schema(self):
        names = [*self.options["columns"].split("\x1f"), self.options.get("geometry") or ""]
        return ", ".join(f"`{c}` string" for c in names if c)

    def reader(self, schema):
        return _Reader(dict(self.options))


def read_geopackage(spark: SparkSession, path: str, layer: str, columns, geometry: str | None = None) -> DataFrame:
    """Columns of a layer as text, and its geometry as WKT where asked for; a column that isn't there raises."""
    import sqlite3

    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as db:
        known = {r[1] for r in db.execute(f'PRAGMA table_info("{layer}")')}
    missing = [c for c in [*columns, *([geometry] if geometry else [])] if c not in known]
    if missing:
        raise ContractError(f"{layer}: missing column(s) {', '.join(missing)}")
    spark.dataSource.register(GeopackageSource)
    reader = spark.read.format("geopackage_layer").option("path", path).option("layer", layer).option("columns", "\x1f".join(columns))
    return (reader.option("geometry", geometry) if geometry else reader).load()
