"""Configuration of a run from environment variables, typed and checked."""

from __future__ import annotations

import datetime
import os
from dataclasses import dataclass, field

from reachmill.functions.contracts import CAP, MODES, ContractError

PREFIX = "REACHMILL_"


class Environment:
    """Typed access to variables with a prefix; an empty variable counts as unset."""

    def __init__(self, variables=None, prefix: str = PREFIX):
        self.variables, self.prefix = os.environ if variables is None else variables, prefix

    def text(self, name: str, default: str | None = None, required: bool = False) -> str | None:
        value = self.variables.get(self.prefix + name) or default
        if required and not value:
            raise ContractError(f"{self.prefix}{name} must be set")
        return value

    def path(self, name: str, default: str | None = None, required: bool = False) -> str | None:
        value = self.text(name, default, required)
        return value and os.path.abspath(value)

    def positive(self, name: str, default: int) -> int:
        value = str(self.text(name, str(default))).strip()
        if not value.isdecimal() or int(value) < 1:
            raise ContractError(f"{self.prefix}{name} must be a whole number from 1")
        return int(value)

    def flag(self, name: str, default: bool = False) -> bool:
        words = {"true": True, "yes": True, "1": True, "false": False, "no": False, "0": False}
        value = str(self.text(name, str(default))).lower()
        if value not in words:
            raise ContractError(f"{self.prefix}{name} must be true or false")
        return words[value]

    def names(self, name: str, default: str = "") -> list[str]:
        return [part.strip() for part in (self.text(name, default) or "").split(",") if part.strip()]

    def departure(self, name: str, default: str | None = None) -> datetime.datetime | None:
        value = self.text(name, default)
        if not value:
            return None
        try:
            return datetime.datetime.strptime(value, "%Y-%m-%dT%H:%M:%S%z").astimezone(datetime.timezone.utc)
        except ValueError:
            raise ContractError(f"{self.prefix}{name} must look like 2026-09-16T08:00:00+0000") from None


@dataclass(frozen=True)
class Config:
    data_dir: str
    output_dir: str
    modes: list[str] = field(default_factory=lambda: list(MODES))
    chunk_size: int = 50_000
    reroute_chunk_size: int = 12_500
    departure: datetime.datetime | None = None
    service_date: str | None = None
    elevation: str = "NONE"
    resume: bool = True
    overwrite: bool = False

    @classmethod
    def read(cls, variables=None, prefix: str = PREFIX) -> Config:
        env = Environment(variables, prefix)
        data = env.path("DATA_DIR", required=True)
        modes = env.names("MODES", ",".join(MODES))
        unknown = [m for m in modes if m not in MODES]
        if unknown or not modes:
            raise ContractError(f"{prefix}MODES: unknown mode(s) {', '.join(unknown) or 'none given'}")
        return cls(
            data, env.path("OUTPUT_DIR", os.path.join(data, "matrix")), modes, env.positive("CHUNK_SIZE", cls.chunk_size), env.positive("REROUTE_CHUNK_SIZE", cls.reroute_chunk_size),
            env.departure("DEPARTURE"), env.text("SERVICE_DATE"), env.text("ELEVATION", cls.elevation), env.flag("RESUME", True), env.flag("OVERWRITE"),
        )

    def routing_parameters(self, **more) -> dict:
        """What a run's identity records of its routing."""
        departure = self.departure and self.departure.strftime("%Y-%m-%dT%H:%M:%SZ")
        return {"max_trip_duration": CAP, "elevation": self.elevation, "departure_datetime": departure, "service_date": self.service_date, **more}
