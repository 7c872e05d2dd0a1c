"""Resumable runs: chunks of routed points, committed one by one under a manifest.

The manifest is a document on the driver; a chunk's rows are a partition of a
Parquet data set.  All chunks that a mode owes are written by one job, which
also counts what breaks the contract; if it fails, they are tried one by one.
A run that is started again with another identity is refused; chunks whose
files are gone or differ are done again; files that a broken run left complete
are taken over.  Results of a run that owes chunks raise, or warn (``strict``).
"""

from __future__ import annotations

import datetime
import hashlib
import os
import shutil
import urllib.parse
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import MATRIX_KEY, ContractError, broken, gain_rules, ladder, matrix_rules, observed, require_matrix_columns, validate_matrix
from reachmill.operators import matrix, routing
from reachmill.operators.joins import dealt, fanned
from reachmill.plans.identity import digest, first_mismatch
from reachmill.sources import io

PENDING, RUNNING, COMPLETE, FAILED = "pending", "running", "complete", "failed"
#: Identity parts in the order in which a difference is reported.
IDENTITY = ("modes", "chunk_size", "cap", "departure", "plan_key", "origins", "destinations", "router")


def _now() -> str:
    return datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")


def file_digests(spark, path: str) -> dict[str, str]:
    """folder: a digest of its data files by name and content, for every folder below path that has any; files are hashed where they are read, unreadable ones left out."""
    if not os.path.isdir(path):
        return {}
    files = spark.read.format("binaryFile").option("ignoreCorruptFiles", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    found: dict[str, list[str]] = {}
    for r in files.select("path", F.sha2("content", 256).alias("h")).collect():  # a line a file
        folder, name = os.path.split(urllib.parse.unquote(urllib.parse.urlparse(r.path).path))
        found.setdefault(folder, []).append(f"{name}:{r.h};")
    return {folder: hashlib.sha256("".join(sorted(lines)).encode()).hexdigest() for folder, lines in found.items()}


class Run:
    """One run in a folder: manifest.json, plan tables and chunks/mode=<m>/chunk_id=<n>."""

    def __init__(self, folder: str, origins: DataFrame, destinations: DataFrame, dest_map: DataFrame, modes=("walk", "bike", "car"), chunk_size: int = 50_000, cap: float = 20, router=routing.stub_dispatch, router_name: str = "stub", departure=None, plan_key: str | None = None):
        routing.probe_modes(modes, departure)
        routing.assert_within_cap(cap)
        self.folder, self.modes, self.chunk_size, self.cap, self.router, self.departure = folder, list(modes), chunk_size, cap, router, departure
        self.spark, self.dest_map = origins.sparkSession, dest_map
        self.identity = {"modes": sorted(modes), "chunk_size": chunk_size, "cap": cap, "departure": departure.isoformat() if departure else None, "plan_key": plan_key, "origins": self._key(origins), "destinations": self._key(destinations), "router": router_name}
        os.makedirs(folder, exist_ok=True)
        self.path = os.path.join(folder, "manifest.json")
        if os.path.exists(self.path):
            self.manifest = io.read_json(self.path, "run")
            mismatch = first_mismatch(self.identity, self.manifest["identity"], IDENTITY)
            if mismatch:
                raise ContractError(f"run cannot be resumed: {mismatch['reason']}")
        else:
            points, link = routing.coordinate_plan(origins, "coord_o")
            dpoints, dlink = routing.coordinate_plan(destinations, "coord_d")
            for name, df in (("points", routing.chunk_ids(points, chunk_size)), ("link", fanned(link, "id")), ("dest_points", dpoints), ("dest_link", dlink)):
                io.write_table(df, self._plan(name))
            n = self.spark.read.parquet(self._plan("points")).agg(F.max("chunk_id")).first()[0] or 0
            entries = [{"mode": m, "chunk_id": c, "status": PENDING, "attempts": 0} for m in self.modes for c in range(1, n + 1)]
            self.manifest = {"kind": "run", "created_at": _now(), "identity": self.identity, "entries": entries}
            self.save()

    @staticmethod
    def _key(points: DataFrame) -> str:
        return routing.universe_key(points.select("id", "lon", "lat")).first()[0]

    def _plan(self, name: str) -> str:
        return os.path.join(self.folder, "plan", name)

    def plan_table(self, name: str) -> DataFrame:
        """A table of the plan: points, link, dest_points or dest_link."""
        return self.spark.read.parquet(self._plan(name))

    def chunk_path(self, mode: str, chunk_id: int) -> str:
        return os.path.join(self.folder, "chunks", f"mode={mode}", f"chunk_id={chunk_id}")

    def save(self) -> None:
        io.write_json(self.manifest, self.path)

    def sweep(self) -> None:
        """Back to pending: complete chunks whose files differ; to complete: valid files of those that a broken run was at.

        Other files are removed: what is left of a chunk may be valid rows, but not all of them.
        """
        digests = file_digests(self.spark, os.path.join(self.folder, "chunks"))
        for e in self.manifest["entries"]:
            sha = digests.get(os.path.abspath(self.chunk_path(e["mode"], e["chunk_id"])))
            if e["status"] == COMPLETE and sha == e["sha256"]:
                continue
            if e["status"] == COMPLETE:
                e.update(status=PENDING, error="files differ from the manifest")
            elif e["status"] == RUNNING:
                try:
                    if sha:
                        self._take_over(e, sha)
                        continue
                    e.update(status=PENDING)
                except ContractError as refused:
                    e.update(status=PENDING, error=str(refused))
            self._discard(e["mode"], e["chunk_id"])
        self.save()

    def _discard(self, mode: str, chunk_id: int) -> None:
        """Removes a chunk's files, all at once by a rename to a name that isn't read."""
        path = self.chunk_path(mode, chunk_id)
        if os.path.isdir(path):
            gone = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}")
            shutil.rmtree(gone, ignore_errors=True)
            os.replace(path, gone)
            shutil.rmtree(gone, ignore_errors=True)

    def _read(self, *paths: str) -> DataFrame:
        """Rows of chunks; a file that is gone or unreadable raises, whatever the session's settings."""
        whole = {"ignoreCorruptFiles": False, "ignoreMissingFiles": False}
        return self.spark.read.options(**whole, basePath=os.path.join(self.folder, "chunks")).parquet(*paths)

    def _take_over(self, entry: dict, sha: str) -> None:
        path = self.chunk_path(entry["mode"], entry["chunk_id"])
        try:
            rows = self._read(path)
            validate_matrix(rows)
            entry.update(status=COMPLETE, sha256=sha, n_rows=rows.count(), validated_at=_now(), error=None)
        except ContractError:
            raise
        except Exception as unreadable:
            raise ContractError(f"unreadable chunk: {unreadable}") from unreadable

    def owed(self) -> list[dict]:
        return [e for e in self.manifest["entries"] if e["status"] != COMPLETE]

    def _rows(self, mode: str, chunks: list[int]) -> DataFrame:
        """The rows of some chunks of a mode, with chunk_id."""
        read = self.plan_table
        points = read("points").where(F.col("chunk_id").isin(chunks))
        routed = self.router(points.drop("chunk_id"), read("dest_points"), cap=self.cap, mode=mode, departure=self.departure)
        chunk = points.select(F.col("id").alias("point_id"), "chunk_id")
        n = read("link").count() * len(chunks) / max(1, sum(e["mode"] == mode for e in self.manifest["entries"]))
        link = dealt(read("link").join(chunk, "point_id"), n, "id")
        return matrix.derive_shared_matrix(routed, link, read("dest_link"), self.dest_map, mode, carry=["chunk_id"])

    def _write(self, mode: str, entries: list[dict]) -> None:
        """Writes the chunks of entries by one job, which counts the rows against each rule, and marks them complete.

        Keys can't occur twice, since the rows come from an aggregation by them.
        """
        chunks = [e["chunk_id"] for e in entries]
        for c in chunks:
            self._discard(mode, c)
        rows = self._rows(mode, chunks)
        require_matrix_columns(rows)
        rows, seen = observed(rows, matrix_rules(), f"chunks-{mode}")
        folder = os.path.join(self.folder, "chunks")
        io.write_chunks(rows, folder)
        found = broken(seen)
        if found:
            raise ContractError("matrix: " + "; ".join(found))
        digests = file_digests(self.spark, os.path.join(folder, f"mode={mode}"))
        paths = {c: os.path.abspath(self.chunk_path(mode, c)) for c in chunks}
        there = [p for p in paths.values() if p in digests]
        counts = {}
        if there:
            counts = {r[0]: r[1] for r in self._read(*there).groupBy("chunk_id").count().collect()}
        written, n = seen.get.get("n_rows", 0), sum(counts.values())
        if n != written:
            raise ContractError(f"matrix: {written} rows were written, of which {n} can be read")
        for e in entries:  # a chunk from which nothing is reached has no files
            e.update(status=COMPLETE, sha256=digests.get(paths[e["chunk_id"]]), n_rows=counts.get(e["chunk_id"], 0), validated_at=_now(), error=None)

    def execute(self, limit: int | None = None) -> list[dict]:
        """Does the owed chunks, at most ``limit`` of them, by one job a mode; a failing chunk is recorded and the others go on."""
        self.sweep()
        owed = self.owed()[:limit]
        for mode in dict.fromkeys(e["mode"] for e in owed):
            own = [e for e in owed if e["mode"] == mode]
            for e in own:
                e.update(status=RUNNING, attempts=e["attempts"] + 1)
            self.save()
            try:
                self._write(mode, own)
            except Exception as failed:
                for e in own:  # which of them is it?
                    try:
                        if len(own) == 1:
                            raise failed
                        self._write(mode, [e])
                    except Exception as alone:
                        e.update(status=FAILED, error=str(alone)[:500])
                        self._discard(mode, e["chunk_id"])
            self.save()
        return self.manifest["entries"]

    def require_complete(self, modes=None, strict: bool = True) -> None:
        """Raises if chunks of the modes (all by default) are owed, with their errors; warns instead unless strict, where others are complete."""
        modes = modes or self.modes
        unknown = [m for m in modes if m not in self.modes]
        if unknown:
            raise ContractError(f"the run has no {', '.join(unknown)}")
        own = [e for e in self.manifest["entries"] if e["mode"] in modes]
        owed = [e for e in own if e["status"] != COMPLETE]
        if owed:
            few = "; ".join(f"{e['mode']} {e['chunk_id']} {e['status']}" + (f" ({e['error']})" if e.get("error") else "") for e in owed[:3])
            found = f"the run owes {len(owed)} of {len(own)} chunk(s) of {', '.join(modes)}: {few}{'; ...' if len(owed) > 3 else ''}"
            if strict or len(owed) == len(own):
                raise ContractError(found)
            warnings.warn(f"{found}; the rows are those of the others", stacklevel=3)

    def _chunks(self, modes, strict: bool = True) -> DataFrame:
        self.require_complete(modes, strict)
        paths = [self.chunk_path(e["mode"], e["chunk_id"]) for e in self.manifest["entries"] if e["status"] == COMPLETE and e["mode"] in modes and e["n_rows"]]
        return self._read(*paths) if paths else self._rows(modes[0], []).limit(0)

    def matrix(self, strict: bool = False) -> DataFrame:
        """The chunks of all modes, with the columns that they share; of a run that owes some the complete ones, with a warning, or an error if strict."""
        parts = [self._chunks(own, strict) for own in ([m for m in self.modes if m != "transit"], [m for m in self.modes if m == "transit"]) if own]
        columns = [*MATRIX_KEY, "chunk_id", "tt_nearest", *ladder()]
        rows = parts[0].select(columns)
        return rows.unionByName(parts[1].select(columns)) if len(parts) > 1 else rows

    def transit(self, strict: bool = True) -> DataFrame:
        """The transit chunks with both percentiles; a run that owes some raises, unless strict is False."""
        return self._chunks(["transit"], strict)

    def gains(self, strict: bool = True) -> DataFrame:
        """The gains of transit over the walk of all chunks, kept by chunk; without strict, of those chunks that have both.

        A chunk's gains are made anew when its transit or its walk was, or when
        their own files are not those that the manifest names.
        """
        for mode in ("walk", "transit"):
            self.require_complete([mode], strict)
        path, kept = os.path.join(self.folder, "gains"), self.manifest.setdefault("gains", {})
        digests = file_digests(self.spark, path)
        at = lambda c: digests.get(os.path.abspath(os.path.join(path, f"chunk_id={c}")))
        by = {(e["mode"], e["chunk_id"]): e["sha256"] for e in self.manifest["entries"] if e["status"] == COMPLETE}
        wanted = {str(c): f"{sha} {by['walk', c]}" for (mode, c), sha in by.items() if mode == "transit" and sha and ("walk", c) in by}
        owed = [int(c) for c, made_of in wanted.items() if kept.get(c, {}).get("of") != made_of or kept[c]["sha256"] != at(c)]
        for c in {n.removeprefix("chunk_id=") for n in (os.listdir(path) if os.path.isdir(path) else []) if n.startswith("chunk_id=")} - {c for c in wanted if int(c) not in owed}:
            shutil.rmtree(os.path.join(path, f"chunk_id={c}"))
            kept.pop(c, None)
        if owed or not wanted:
            transit = self.transit(strict).where(F.col("chunk_id").isin(owed))
            walk = self._chunks(["walk"], strict).where(F.col("chunk_id").isin(owed)).hint("shuffle_hash")  # keys are unique, so a task's part is even, and unsorted
            made = matrix.transit_gains(transit, walk, carry=["chunk_id"])
            if not wanted:
                return made
            made, seen = observed(made, gain_rules(), "gains")
            made.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk_id").parquet(path)
            found = broken(seen)
            if found:
                raise ContractError("transit gains: " + "; ".join(found))
            digests = file_digests(self.spark, path)
            kept |= {str(c): {"of": wanted[str(c)], "sha256": at(c)} for c in owed}
            self.save()
        return self.spark.read.parquet(path)

    @staticmethod
    def dry_run(origins: DataFrame, destinations: DataFrame, modes=("walk", "bike", "car"), chunk_size: int = 50_000, departure=None) -> dict:
        """What a run would do, without a folder: numbers of identities, coordinates and chunks by side and mode."""
        routing.probe_modes(modes, departure)
        sides = {"origins": origins, "destinations": destinations}
        out = {name: routing.census(df, df.select("lon", "lat").distinct(), chunk_size).first().asDict() for name, df in sides.items()}
        return {"kind": "dry_run", "modes": list(modes), **out, "chunks": out["origins"]["n_chunks"] * len(modes)}

    def metadata(self) -> dict:
        """Sums over the manifest by mode, with the identity's digest."""
        by: dict = {}
        for e in self.manifest["entries"]:
            m = by.setdefault(e["mode"], {"chunks": 0, "complete": 0, "n_rows": 0})
            m["chunks"] += 1
            m["complete"] += e["status"] == COMPLETE
            m["n_rows"] += e["n_rows"] if e["status"] == COMPLETE else 0
        return {"kind": "run_metadata", "identity": digest(self.identity), "modes": by}


def run_metadata(entries: DataFrame) -> DataFrame:
    """mode, n_chunks, n_rows, route_seconds over manifest entries held as a table."""
    return entries.groupBy("mode").agg(F.count("*").alias("n_chunks"), F.sum("n_rows").cast("long").alias("n_rows"), F.sum("route_seconds").cast("long").alias("route_seconds"))
