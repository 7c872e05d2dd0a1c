"""Identities of runs: canonical values, the first difference, and documents without absolute paths."""

from __future__ import annotations

import hashlib
import json
import math
import os
import re
from decimal import Decimal

from reachmill.functions.contracts import ContractError

# The parts of a routing run's identity, in the order in which a difference is reported.
ROUTING_RUN = (
    "version", "network_fingerprint",
    "routing_parameters.walk_speed", "routing_parameters.bike_speed", "routing_parameters.max_trip_duration", "routing_parameters.elevation",
    "routing_parameters.departure_datetime", "routing_parameters.time_window", "routing_parameters.percentiles", "routing_parameters.max_rides",
    "routing_parameters.draws_per_minute", "routing_parameters.service_date", "routing_parameters.transit_required_ids", "routing_parameters.feed_activity_window",
    "universes.bdnb_residential", "universes.bpe_destinations",
    "plan_census.chunk_size", "plan_census.n_chunks", "plan_census.n_origins", "plan_census.n_origin_coords", "plan_census.n_destinations", "plan_census.n_dest_coords",
    "artifact_layout", "identity_extra", "git_sha",
)


def _number(value) -> str:
    if isinstance(value, int) or not math.isfinite(value):
        return str(value)
    text = format(Decimal(f"{value:.15g}"), "f")
    text = text.rstrip("0").rstrip(".") if "." in text else text
    return "0" if text == "-0" else text


def _plain(value):
    if isinstance(value, dict):
        return {str(k): _plain(v) for k, v in value.items()}
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return int(value) if isinstance(value, float) and value.is_integer() else float(f"{value:.15g}") if isinstance(value, float) else value


def canonical(value) -> str:
    """One text for equal values: null is not the empty text, 20 equals 20.0, numbers count to 15 digits, keys have no order."""
    if value is None:
        return "__null__"
    if isinstance(value, (dict, list, tuple)):
        return json.dumps(_plain(value), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    if isinstance(value, bool):
        return str(value).lower()
    return _number(value) if isinstance(value, (int, float)) else str(value)


def digest(identity: dict) -> str:
    return hashlib.sha256(canonical(identity).encode()).hexdigest()


def _part(document, path: str):
    for name in path.split("."):
        document = document.get(name) if isinstance(document, dict) else None
    return document


def first_mismatch(expected: dict, found: dict, order=ROUTING_RUN, waived=()) -> dict | None:
    """component, expected, found and reason of the first part in order that differs and is not waived; None if all agree."""
    for component in order:
        want, got = canonical(_part(expected, component)), canonical(_part(found, component))
        if want != got and component not in waived:
            return {"component": component, "expected": want, "found": got, "reason": f"{component} differs: {want} is asked for, {got} is recorded"}
    return None


def is_absolute(text) -> bool:
    """Is it the text of an absolute path: from a root, a share or a drive?"""
    return isinstance(text, str) and re.match(r"[/\\]|[A-Za-z]:[/\\]", text) is not None


def portable(path: str, root: str) -> str:
    """The path relative to root, with forward slashes; the empty text for root itself; outside of root an error."""
    path, root = os.path.realpath(path), os.path.realpath(root)
    if os.path.commonpath([path, root]) != root:
        raise ContractError(f"{path} is not below {root}")
    return "" if path == root else os.path.relpath(path, root).replace(os.sep, "/")


def make_portable(document, root: str):
    """The document with every absolute path below root made relative; everything else stays."""
    if isinstance(document, dict):
        return {k: make_portable(v, root) for k, v in document.items()}
    if isinstance(document, (list, tuple)):
        return [make_portable(v, root) for v in document]
    if is_absolute(document):
        try:
            return portable(document, root)
        except (ContractError, ValueError):
            return document
    return document


def absolute_paths(document, at: str = "metadata") -> list[str]:
    """Field and value of every absolute path in a document."""
    if isinstance(document, dict):
        return [hit for k, v in document.items() for hit in absolute_paths(v, f"{at}.{k}")]
    if isinstance(document, (list, tuple)):
        return [hit for i, v in enumerate(document) for hit in absolute_paths(v, f"{at}[{i}]")]
    return [f"{at}: {document}"] if is_absolute(document) else []


def require_portable(document, at: str = "metadata"):
    found = absolute_paths(document, at)
    if found:
        raise ContractError("absolute path(s): " + "; ".join(found))
    return document
