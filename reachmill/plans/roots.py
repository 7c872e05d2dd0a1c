"""Folders that last: a mark on the root, a refusal to work elsewhere, and networks found again by what they were built from."""

from __future__ import annotations

import hashlib
import os

from reachmill.functions.contracts import BORDER_WIDTH_M, CAP, ContractError
from reachmill.plans.identity import first_mismatch
from reachmill.sources import io

MARK = ".durable-root.json"
#: Parts of a network's identity, in the order in which a difference is reported.
NETWORK = ("osm", "transit_n", "transit", "elevation", "engine", "width_m", "cap_minutes")


def mark_root(folder: str, again: bool = False) -> str:
    """Marks a folder as a root whose content lasts; marking it once more must be asked for."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, MARK)
    if os.path.exists(path) and not again:
        raise ContractError(f"{folder} is marked already")
    io.write_json({"kind": "durable_root", "version": 1}, path)
    return path


def find_root(path: str) -> str | None:
    """The deepest marked folder above a path, as it is written or with its links resolved."""
    for start in dict.fromkeys((os.path.abspath(path), os.path.realpath(path))):
        at = start
        while True:
            if os.path.exists(os.path.join(at, MARK)):
                return at
            up = os.path.dirname(at)
            if up == at:
                break
            at = up
    return None


def require_root(path: str, root: str) -> str:
    """path, if it lies below the marked root and not, by a link, elsewhere."""
    found = find_root(path)
    if found is None or os.path.realpath(found) != os.path.realpath(root):
        raise ContractError(f"{path} is not below the marked root {root}")
    if os.path.commonpath([os.path.realpath(root), os.path.realpath(path)]) != os.path.realpath(root):
        raise ContractError(f"{path} leads out of {root}")
    return path


def network_identity(osm: dict, feeds: list[dict], elevation: dict | None = None, engine: str = "stub", width_m: float = BORDER_WIDTH_M, cap: float = CAP) -> dict:
    """What a network was built from: pins (id, sha256) of streets, timetables and elevation, the engine and the limits."""
    pin = lambda p: f"{p['id']}={p['sha256']}"
    if len({f["id"] for f in feeds}) != len(feeds):
        raise ContractError("a timetable is pinned twice")
    return {"osm": pin(osm), "transit_n": len(feeds), "transit": sorted(map(pin, feeds)), "elevation": pin(elevation) if elevation else "NONE", "engine": engine, "width_m": int(width_m), "cap_minutes": int(cap)}


def network_key(identity: dict) -> str:
    lines = [f"{part}={','.join(v) if isinstance(v, list) else v}" for part, v in ((p, identity[p]) for p in NETWORK)]
    return hashlib.sha256("\n".join(["network-identity/1", *lines]).encode()).hexdigest()


def save_network(folder: str, identity: dict, files) -> str:
    """The folder of a network below ``folder``, with its identity and its files' digests beside it."""
    path = os.path.join(folder, network_key(identity)[:16])
    os.makedirs(path, exist_ok=True)
    io.write_json({"kind": "network", "identity": identity, "files": {os.path.basename(f): io.sha256_file(f) for f in files}}, os.path.join(path, "network.json"))
    return path


def probe_network(folder: str, identity: dict) -> dict:
    """hit, path and reason: is there a network of this identity whose record proves it and whose files are unchanged?"""
    path = os.path.join(folder, network_key(identity)[:16])
    record = os.path.join(path, "network.json")
    if not os.path.exists(record):
        return {"hit": False, "path": path, "reason": "no network of this identity"}
    found = io.read_json(record, "network")
    differs = first_mismatch(identity, found["identity"], NETWORK)
    if differs:
        return {"hit": False, "path": path, "reason": differs["reason"]}
    for name, sha in found["files"].items():
        file = os.path.join(path, name)
        if not os.path.exists(file) or io.sha256_file(file) != sha:
            return {"hit": False, "path": path, "reason": f"{name} is gone or differs"}
    return {"hit": True, "path": path, "reason": None}


def find_network(folder: str, osm_sha256: str) -> list[str]:
    """Folders of the networks that were built from these streets."""
    out = []
    for name in sorted(os.listdir(folder)) if os.path.isdir(folder) else ():
        record = os.path.join(folder, name, "network.json")
        if os.path.exists(record) and io.read_json(record, "network")["identity"]["osm"].endswith(f"={osm_sha256}"):
            out.append(os.path.join(folder, name))
    return out
