"""Staging of timetable archives: overrides, pins, filters, gates, then the files a router reads.

Feeds are a short list of records on the driver: id, cached_path, sha256.
"""

from __future__ import annotations

import os
import shutil

from reachmill.functions.contracts import ContractError
from reachmill.sources import io

# What an override's lineage records.
LINEAGE = ("source_service_date", "target_service_date", "source_sha256", "source_resource_id")
STAGED = "staged.json"


def resolve(path: str, data_dir: str) -> str:
    """A recorded path, taken below data_dir unless absolute; it must exist."""
    found = path if os.path.isabs(path) else os.path.join(data_dir, path)
    if not os.path.isfile(found):
        raise ContractError(f"no file {path}")
    return found


def override(feeds: list[dict], overrides: dict[str, dict]) -> list[dict]:
    """The feeds with the files of overrides(id: output_path, sha256, policy, ...) in place of their own, and the lineage noted."""
    unknown = sorted(set(overrides) - {f["id"] for f in feeds})
    if unknown:
        raise ContractError(f"override of feed(s) that are not selected: {', '.join(unknown)}")
    out = []
    for feed in feeds:
        new = overrides.get(feed["id"])
        if new is not None:
            lacking = [k for k in ("output_path", "sha256") if not new.get(k)]
            if lacking:
                raise ContractError(f"override of {feed['id']} lacks {', '.join(lacking)}")
            if not os.path.isfile(new["output_path"]):
                raise ContractError(f"override of {feed['id']}: no file {new['output_path']}")
            role = new.get("policy") or "override"
            lineage = {"policy": role, "sha256": new["sha256"], **{k: str(new[k]) for k in LINEAGE if new.get(k) is not None}}
            if new.get("source_path"):
                lineage["source_artifact"] = os.path.basename(new["source_path"])
            feed = {**feed, "cached_path": os.path.abspath(new["output_path"]), "sha256": new["sha256"], "staging_role": role, "staging_override": lineage}
        out.append(feed)
    return out


def verify_pins(feeds: list[dict], data_dir: str) -> dict[str, str]:
    """The file of each feed, by id, if every one has its recorded digest; otherwise one error that names all failures."""
    if not feeds:
        raise ContractError("no feeds selected")
    paths, failures = {}, []
    for feed in feeds:
        lacking = [k for k in ("sha256", "cached_path") if not feed.get(k)]
        try:
            if lacking:
                raise ContractError(f"no {' and no '.join(lacking)} recorded")
            path = resolve(feed["cached_path"], data_dir)
            got = io.sha256_file(path)
            if got != str(feed["sha256"]).lower():
                raise ContractError(f"pinned as {feed['sha256']}, the file has {got}")
            paths[feed["id"]] = path
        except (ContractError, OSError) as failed:
            failures.append(f"{feed['id']}: {failed}")
    if failures:
        raise ContractError(f"{len(failures)} feed(s) failed their pins: " + "; ".join(failures))
    return paths


def stage(feeds: list[dict], target: str, data_dir: str, overrides: dict[str, dict] | None = None, excluded: dict[str, str] | None = None, transform=None, gate=None) -> dict:
    """Stages feeds as <id>.zip in target and returns the identity block: feeds, skipped, excluded.

    ``excluded`` gives a reason by id.  ``transform(feed, path)`` may return
    another archive, or None to skip the feed.  ``gate(paths)`` raises to refuse
    the whole set.  Nothing in target changes before all of these have passed;
    then files that an earlier staging left there and this one lacks are removed.
    """
    excluded = excluded or {}
    chosen = override([f for f in feeds if f["id"] not in excluded], overrides or {})
    paths, ready, skipped = verify_pins(chosen, data_dir), {}, []
    for feed in chosen:
        path = transform(feed, paths[feed["id"]]) if transform else paths[feed["id"]]
        if path is None:
            skipped.append(feed["id"])
            continue
        io.check_timetable_zip(path)
        ready[feed["id"]] = path
    if gate:
        gate(ready)
    os.makedirs(target, exist_ok=True)
    note = os.path.join(target, STAGED)
    before = io.read_json(note, "staged")["feeds"] if os.path.exists(note) else []
    staged = []
    for feed in chosen:
        if feed["id"] in ready:
            name = f"{feed['id']}.zip"
            part = os.path.join(target, f".{name}.part")
            shutil.copyfile(ready[feed["id"]], part)
            os.replace(part, os.path.join(target, name))
            staged.append({"id": feed["id"], "file": name, "pin": feed["sha256"], "sha256": io.sha256_file(os.path.join(target, name)), **{k: feed[k] for k in ("staging_role", "staging_override") if k in feed}})
    for stale in {f["file"] for f in before} - {f["file"] for f in staged}:
        if os.path.exists(os.path.join(target, stale)):
            os.remove(os.path.join(target, stale))
    block = {"kind": "staged", "feeds": staged, "skipped": skipped, "excluded": [{"id": f["id"], "reason": excluded[f["id"]]} for f in feeds if f["id"] in excluded]}
    io.write_json(block, note)
    return block
