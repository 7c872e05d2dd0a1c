"""Tables that are kept and changed in place of buckets: copy on write, one version after the other.

A table is dealt into buckets by a hash of one column.  Data lie in
``data/version=<v>/bucket=<b>``; ``versions/<v>.json`` tells which version of each
bucket is the current one.  A change writes the buckets that it touches under a
new version and then commits by putting the new document there, which fails if
another writer came first.  The files of all other buckets stay as they are,
byte for byte, and a change that breaks off leaves nothing that is read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reachmill.functions.contracts import ContractError, require
from reachmill.sources.lineage import cut

#: Rows of a row group at most.
ROW_GROUP = 65_536


class Folder:
    """The few file operations that documents need, on whatever store a path names."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm, self._spark, self.path = spark._jvm, spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(s.getPath().getName() for s in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def put(self, name: str, text: str) -> None:
        """A new file with a text, whole or not at all; one that is there already raises."""
        part, at = self._at(f"{name}.{uuid.uuid4().hex}.part"), self._at(name)
        stream = self._fs.create(part)
        stream.write(text.encode())
        stream.close()
        fs = self._jvm.org.apache.hadoop.fs
        context = fs.FileContext.getFileContext(self._fs.getUri(), self._spark._jsc.hadoopConfiguration())
        try:
            context.rename(part, at, self._spark.sparkContext._gateway.new_array(fs.Options.Rename, 0))
        except Exception as taken:
            self._fs.delete(part, False)
            raise ContractError(f"{name}: another writer came first") from taken

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)


class StoredTable:
    """A table in a folder, in buckets by a hash of the column ``by``."""

    def __init__(self, spark: SparkSession, path: str, by: str, buckets: int = 64):
        self.spark, self.by, self.folder = spark, by, Folder(spark, path)
        known = self.state()
        self.buckets = known.get("n_buckets", buckets)
        if known and known["by"] != by:
            raise ContractError(f"{path} is bucketed by {known['by']}")

    def state(self, version: int | None = None) -> dict:
        """The document of the current version (or a given one); empty before the first."""
        found = [int(n[:-5]) for n in self.folder.names("versions") if n.endswith(".json")]
        version = max(found, default=0) if version is None else version
        return json.loads(self.folder.read(f"versions/{version}.json")) if version else {}

    @property
    def version(self) -> int:
        return self.state().get("version", 0)

    def bucket(self, column: str | None = None) -> Column:
        return F.pmod(F.xxhash64(F.col(column or self.by).cast("string")), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows belong to."""
        require(rows, [self.by], "rows")
        return sorted(r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect())

    def read(self, buckets=None, version: int | None = None) -> DataFrame | None:
        """The rows of a version (the current one), of all buckets or some; None if there are no files."""
        state = self.state(version)
        held = state.get("at", {})
        paths = [f"{self.folder.path}/data/version={v}/bucket={b}" for b, v in held.items() if buckets is None or int(b) in set(buckets)]
        return self.spark.read.schema(StructType.fromJson(state["schema"])).parquet(*paths) if paths else None

    def replace(self, rows: DataFrame, buckets, mark: dict | None = None) -> int:
        """Makes rows the whole content of ``buckets``, and returns the new version; rows of other buckets raise.

        Columns that are new are null in the buckets that stay; one of another
        type than before raises.  ``mark`` is kept with the version and with those after it.
        """
        old = self.state()
        fields = {f["name"]: f for f in old.get("schema", {}).get("fields", [])}
        for f in rows.schema.jsonValue()["fields"]:
            if fields.setdefault(f["name"], {**f, "nullable": True})["type"] != f["type"]:
                raise ContractError(f"column {f['name']} has another type than before")
        version, wanted = old.get("version", 0) + 1, sorted(set(buckets))
        own = self.bucket()
        inside = own.isin(wanted) if wanted else F.lit(False)
        bucket = F.when(inside, own).otherwise(F.raise_error(F.lit("a row of a bucket that is not replaced")).cast("int"))
        path = f"{self.folder.path}/data/version={version}"
        # by bucket, but a bucket beyond the advisory size is written by several tasks
        writer = rows.withColumn("bucket", bucket).hint("rebalance", F.col("bucket")).write.mode("overwrite").option("compression", "zstd").option("parquet.block.row.count.limit", ROW_GROUP)
        writer.partitionBy("bucket").parquet(path)
        made = {n.removeprefix("bucket=") for n in self.folder.names(f"data/version={version}") if n.startswith("bucket=")}
        at = {b: v for b, v in old.get("at", {}).items() if int(b) not in set(wanted)} | {b: version for b in made}
        document = {"kind": "stored_table", "version": version, "by": self.by, "n_buckets": self.buckets, "schema": {"type": "struct", "fields": list(fields.values())}, "at": dict(sorted(at.items(), key=lambda x: int(x[0]))), "mark": {**old.get("mark", {}), **(mark or {})}}
        self.folder.put(f"versions/{version}.json", json.dumps(document, sort_keys=True))
        return version

    def upsert(self, incoming: DataFrame, merge, mark: dict | None = None) -> int:
        """Merges incoming rows into the buckets they belong to; only these are read.  merge(existing, incoming) gives all their rows."""
        incoming = cut(incoming)
        buckets = self.touched(incoming)
        existing = self.read(buckets)
        return self.replace(merge(existing, incoming) if existing is not None else merge(incoming.limit(0), incoming), buckets, mark)

    def vacuum(self) -> list[str]:
        """Removes versions of buckets that the current document doesn't name, and documents before it; what goes can't be read again."""
        state = self.state()
        kept = {(str(v), str(b)) for b, v in state.get("at", {}).items()}
        gone = []
        for folder in self.folder.names("data"):
            version = folder.removeprefix("version=")
            gone += [f"data/{folder}/{n}" for n in self.folder.names(f"data/{folder}") if n.startswith("bucket=") and (version, n.removeprefix("bucket=")) not in kept]
        gone += [f"versions/{n}" for n in self.folder.names("versions") if n != f"{state.get('version')}.json"]
        for name in gone:
            self.folder.remove(name)
        return gone
