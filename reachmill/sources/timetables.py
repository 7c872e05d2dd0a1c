"""Sets of timetable archives as a data source: a task reads or writes whole archives, line by line.

Read, an archive is rows (feed_id, member, line, fields): the feed is the file's
name, ``fields`` maps lower-case column names to text, with empty and NA as null.
Written, the rows of a feed become one archive that depends on nothing else.
Archives are opened where the tasks run, by pyarrow's file systems.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from reachmill.functions.contracts import ContractError
from reachmill.sources.lineage import cut

HELD_LINES = 10_000
SCHEMA = "feed_id string, member string, line long, fields map<string,string>"


def _file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else f"file:{path}")


def _lower(name: str) -> str:
    return name.rsplit("/", 1)[-1].lower()


class _Archive(InputPartition):
    def __init__(self, path):
        super().__init__(path)
        self.path = path


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"].rstrip("/")
        self.members = {m for m in (options.get("members") or "").split(",") if m}

    def partitions(self):
        from pyarrow import fs

        system, root = _file_system(self.path)
        found = system.get_file_info(fs.FileSelector(root)) if system.get_file_info(root).type == fs.FileType.Directory else [system.get_file_info(root)]
        return [_Archive(f.path) for f in sorted(found, key=lambda f: f.path) if f.path.lower().endswith(".zip") and f.type == fs.FileType.File] or [_Archive("")]

    def read(self, partition):
        import zipfile

        if not partition.path:
            return
        system, _ = _file_system(self.path)
        feed = partition.path.rsplit("/", 1)[-1][:-4]
        with system.open_input_file(partition.path) as file:
            try:
                archive = zipfile.ZipFile(file)
            except (zipfile.BadZipFile, ValueError, OSError) as broken:
                raise ContractError(f"{feed}: {broken}") from broken
            names = [n for n in archive.namelist() if not n.endswith("/") and (not self.members or _lower(n) in self.members)]
            twice = sorted({_lower(n) for n in names if sum(_lower(n) == _lower(m) for m in names) > 1})
            if twice:
                raise ContractError(f"{feed}: member(s) {', '.join(twice)} occur several times")
            for name in names:
                yield from self._lines(feed, name, archive)

    @staticmethod
    def _lines(feed, name, archive):
        import csv
        import io
        import itertools

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        with archive.open(name) as raw:
            rows = csv.reader(io.TextIOWrapper(raw, "utf-8-sig", newline=""))
            header = [c.strip().lower() for c in next(rows, [])]
            if len(set(header)) < len(header):
                raise ContractError(f"{feed}/{name}: columns that differ by case only")
            wide, held, line = len(header), [], 0

            def batch():
                n = len(held)
                values = pa.array(itertools.chain.from_iterable(held), pa.string())
                values = pc.if_else(pc.is_in(values, pa.array(["", "NA"])), None, values)
                fields = pa.MapArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * wide), pa.array(header, pa.string()).take(pa.array(np.tile(np.arange(wide), n))), values)
                columns = [pa.array([feed] * n, pa.string()), pa.array([_lower(name)] * n, pa.string()), pa.array(np.arange(line - n + 1, line + 1)), fields]
                return pa.RecordBatch.from_arrays(columns, names=["feed_id", "member", "line", "fields"])

            for row in rows:
                if row:
                    held.append(row if len(row) == wide else (row + [""] * wide)[:wide])
                    line += 1
                    if len(held) == HELD_LINES:
                        yield batch()
                        held = []
            if held:
                yield batch()


def _pieces(folder: str):
    """Writes each run of lines of one feed and member to a file of its own; returns what files there are, and their place."""

    def run(batches):
        import itertools
        import uuid

        import pyarrow as pa
        from pyspark import TaskContext

        system, root = _file_system(folder)
        place, made, key, file = TaskContext.get().partitionId(), [], None, None
        for batch in batches:
            feeds, members, headers, texts = (c.to_pylist() for c in batch.columns)
            at = 0
            for own, same in itertools.groupby(zip(feeds, members, headers)):
                n = sum(1 for _ in same)
                if own != key:
                    if file is not None:
                        file.close()
                    key, name = own, f"{root}/{uuid.uuid4().hex}.gz"
                    made.append((own[0], own[1], place, own[2], name))
                    file = system.open_output_stream(name, compression="gzip")
                file.write(("\n".join(texts[at : at + n]) + "\n").encode())
                at += n
        if file is not None:
            file.close()
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], k) for i, k in enumerate(kinds)], names=["feed_id", "member", "place", "header", "file"])

    return run


def _joined(path: str):
    """The pieces of one feed as one archive that depends on nothing else, under a passing name."""

    def run(key, pieces):
        import itertools
        import shutil
        import uuid
        import zipfile

        import pyarrow as pa

        system, root = _file_system(path)
        feed = key[0].as_py()
        part = f"{root}/.{feed}.{uuid.uuid4().hex}.part"
        order = sorted(pieces.to_pylist(), key=lambda p: (p["member"], p["place"]))
        with system.open_output_stream(part) as stream, zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED) as archive:
            for member, own in itertools.groupby(order, lambda p: p["member"]):
                own = list(own)
                entry = zipfile.ZipInfo(member, (1980, 1, 1, 0, 0, 0))
                entry.compress_type = zipfile.ZIP_DEFLATED
                with archive.open(entry, "w", force_zip64=True) as text:
                    text.write((own[0]["header"] + "\n").encode())
                    for piece in own:
                        with system.open_input_stream(piece["file"], compression="gzip") as lines:
                            shutil.copyfileobj(lines, text, 1 << 20)
        return pa.table({"part": [part], "final": [f"{root}/{feed}.zip"]})

    return run


class TimetableSource(DataSource):
    """format("timetable_archives"): a folder of archives, or one; option members names those that are read."""

    @classmethod
    def name(cls):
        return "timetable_archives"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(dict(self.options))


def read_timetables(spark: SparkSession, path: str, members=()) -> DataFrame:
    """feed_id, member, line, fields of all archives in a folder; some members only, if named."""
    spark.dataSource.register(TimetableSource)
    return spark.read.format("timetable_archives").option("members", ",".join(m.lower() for m in members)).load(path)


def _text(values):
    """A line of delimited text of an array of values, as the csv module writes it: null as empty."""
    plain = lambda v: F.coalesce(v, F.lit(""))
    quoted = lambda v: F.when(plain(v).rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(plain(v), F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(plain(v))
    joined = F.array_join(F.transform(values, quoted), ",")
    return F.when((F.size(values) == 1) & (joined == ""), F.lit('""')).otherwise(joined)


def _archived(parts, path: str) -> None:
    """Archives of parts(feed_id, member, header, text and what orders the lines), each a table and the names of the latter.

    Lines are dealt by ranges and written as pieces; one task a feed then copies its pieces, without their rows.
    """
    import uuid
    from functools import reduce

    system, root = _file_system(path.rstrip("/"))
    folder = f"{path.rstrip('/')}/.pieces-{uuid.uuid4().hex}"
    system.create_dir(_file_system(folder)[1], recursive=True)
    schema = "feed_id string, member string, place long, header string, file string"
    made = []
    try:
        found = []
        for rows, order in parts:
            by = ["feed_id", "member", *order]
            dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("feed_id", "member", "header", "text")
            found.append(cut(dealt.mapInArrow(_pieces(folder), schema)))
        pieces = reduce(lambda a, b: a.unionByName(b), found)
        made = pieces.groupBy("feed_id").applyInArrow(_joined(path.rstrip("/")), "part string, final string").collect()  # a row a feed
        for part, final in made:
            system.move(part, final)
    finally:
        system.delete_dir(_file_system(folder)[1])


def write_timetables(lines: DataFrame, path: str) -> None:
    """An archive for each feed of lines(feed_id, member, line, fields), its members and their columns in order of name.

    A member without lines isn't written.
    """
    keys = F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.map_keys("fields")))))
    headers = lines.groupBy("feed_id", "member").agg(keys.alias("columns"))
    rows = lines.select("feed_id", "member", "line", "fields").join(F.broadcast(headers), ["feed_id", "member"])
    text = _text(F.transform("columns", lambda c: F.col("fields")[c]))
    _archived([(rows.select("feed_id", "member", "line", _text(F.col("columns")).alias("header"), text.alias("text")), ["line"])], path)


def write_members(tables, path: str) -> None:
    """An archive for each feed of tables: (table with feed_id, member, the columns that order its lines) each, a member's columns in order of name."""
    parts = []
    for table, member, order in tables:
        columns = sorted(c for c in table.columns if c != "feed_id")
        header, text = F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("string") for c in columns])
        parts.append((table.select("feed_id", F.lit(member).alias("member"), *order, _text(header).alias("header"), _text(text).alias("text")), list(order)))
    _archived(parts, path)


def archives(spark: SparkSession, path: str):
    """A function of members that reads the lines of these alone, of all without any; what works on lines takes it in their place."""
    return lambda members=(): read_timetables(spark, path, members)


def of_members(lines, *members: str) -> DataFrame:
    """The lines of some members; ``lines`` is a table of them or archives()."""
    return lines(members) if callable(lines) else lines.where(F.col("member").isin(*members))


def all_lines(lines) -> DataFrame:
    return lines() if callable(lines) else lines


def member_table(lines, member: str, columns) -> DataFrame:
    """feed_id and columns of one member of all feeds; a column that a feed doesn't have is null."""
    return of_members(lines, member).select("feed_id", *[F.col("fields")[c].alias(c) for c in columns])


def member_lines(table: DataFrame, member: str, order) -> DataFrame:
    """The rows of a table with feed_id as lines of a member, numbered in each feed by ``order``."""
    from pyspark.sql import Window

    columns = [c for c in table.columns if c != "feed_id"]
    fields = F.map_from_arrays(F.array(*[F.lit(c) for c in columns]), F.array(*[F.col(c).cast("string") for c in columns]))
    return table.select("feed_id", F.lit(member).alias("member"), F.row_number().over(Window.partitionBy("feed_id").orderBy(*order)).cast("long").alias("line"), fields.alias("fields"))
