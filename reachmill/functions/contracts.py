"""Constants of the data model, column names made from them, and validators that raise."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

MODES = ("walk", "transit", "bike", "car")
ATOMIC = ("walk", "bike", "car")
RUNGS = (5, 10, 15, 20)
CAP = max(RUNGS)
BORDER_WIDTH_M = 25_000
PROBS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
LEVELS = {"commune": ["code_insee", "nom_commune"], "epci": ["epci"], "departement": ["code_departement"], "region": ["region"]}
MATRIX_KEY = ["batiment_id", "TYPEQU", "mode"]
MONOLITH_KEY = ["address_id", "TYPEQU"]
# Equipment types of each cluster; A206 belongs to two.
CLUSTERS = {
    "alimentation": ["B104", "B105", "B201", "B202", "B207"],
    "sante": ["D265", "D307"],
    "administration": ["A129", "A128", "A206"],
    "ecole": ["C108", "C109"],
    "banque": ["A203", "A206"],
}


class ContractError(ValueError):
    """Data that breaks a contract; the message lists every violation."""


def ladder(suffix: str = "") -> list[str]:
    return [f"count_{r}{suffix}" for r in RUNGS]


def nearest_columns() -> list[str]:
    return [f"nearest_{m}" for m in ATOMIC]


def atomic_count_columns() -> list[str]:
    return [f"count_{r}_{m}" for m in ATOMIC for r in RUNGS]


def gain_columns() -> list[str]:
    return ["walk_available", "time_gain_p1", "time_gain_p50"] + [f"count_gain_{r}_{p}" for p in ("p1", "p50") for r in RUNGS]


def monolith_gain_columns() -> list[str]:
    return ["transit_gain_walk_available", "transit_gain_time_p1", "transit_gain_time_p50"] + [f"transit_gain_count_{r}_{p}" for p in ("p1", "p50") for r in RUNGS]


def stat_suffixes(probs=PROBS) -> list[str]:
    return ["mean", *(f"p{round(100 * p):g}" for p in probs), "max", "share"]


def require(df: DataFrame, columns, what: str = "table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ContractError(f"{what}: missing column(s) {', '.join(missing)}")


def duplicates(df: DataFrame, key) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")


def require_unique(df: DataFrame, key, what: str = "table") -> None:
    if duplicates(df, key).limit(1).count():
        raise ContractError(f"{what}: duplicate key on {', '.join(key)}")


def require_none(df: DataFrame, what: str) -> None:
    """Raises with up to five examples if df has rows."""
    found = df.limit(5).collect()
    if found:
        raise ContractError(f"{what}: {'; '.join(str(tuple(r)) for r in found)}")


def assert_within_cap(minutes) -> float:
    if isinstance(minutes, bool) or not isinstance(minutes, (int, float)) or not 0 < minutes <= CAP:
        raise ContractError(f"trip duration must be a number over 0 and at most {CAP}")
    return minutes


def assert_probs(probs) -> tuple:
    probs = tuple(probs)
    if not probs or any(not 0 < p < 1 for p in probs) or any(a >= b for a, b in zip(probs, probs[1:])):
        raise ContractError("probabilities must increase strictly within (0, 1)")
    return probs


def type_catalogue(types: DataFrame, column: str = "TYPEQU") -> DataFrame:
    """Distinct, non-empty types; none left is an error."""
    out = types.select(F.col(column).cast("string").alias("TYPEQU")).where("TYPEQU is not null and TYPEQU <> ''").distinct()
    if not out.limit(1).count():
        raise ContractError("type catalogue is empty")
    return out


def off_ladder(columns) -> list[str]:
    allowed = {*ladder(), *ladder("_p50")}
    return [c for c in columns if re.match(r"count_\d+", c) and c not in allowed]


def matrix_rules() -> dict:
    """name: a condition that holds for rows against the rule, for every rule of a matrix row."""
    whole = lambda c: F.col(c).isNull() | (F.col(c) < 0) | (F.col(c) != F.floor(F.col(c)))
    rules = {
        "empty_id": F.coalesce(F.col("batiment_id"), F.lit("")).eqNullSafe("") | F.coalesce(F.col("TYPEQU"), F.lit("")).eqNullSafe(""),
        "mode": ~F.coalesce(F.col("mode").isin(*MODES), F.lit(False)),
        "cap": ~F.coalesce(F.col("tt_nearest").between(0, CAP), F.lit(False)),
        "count": F.lit(False),
        "nearest": F.lit(False),
        "monotone": F.lit(False),
    }
    for r in RUNGS:
        c = f"count_{r}"
        rules["count"] = rules["count"] | whole(c)
        rules["nearest"] = rules["nearest"] | F.coalesce((F.col(c) >= 1) != (F.col("tt_nearest") <= r), F.lit(False))
    for a, b in zip(RUNGS, RUNGS[1:]):
        rules["monotone"] = rules["monotone"] | F.coalesce(F.col(f"count_{a}") > F.col(f"count_{b}"), F.lit(False))
    return rules


def _report(rows: DataFrame, rules: dict, key) -> DataFrame:
    """violation, n: row rules and the uniqueness of the key, in one pass over the rows.

    Rows are counted by key, which tells keys that occur twice, and the rules
    are summed along with that.
    """
    by = rows.groupBy(*key).agg(F.count("*").alias("_n"), *[F.count_if(v).alias(f"_{k}") for k, v in rules.items()])
    one = by.agg(*[F.coalesce(F.sum(f"_{k}"), F.lit(0)).cast("long").alias(k) for k in rules], F.count_if(F.col("_n") > 1).alias("duplicate_key"))
    return one.unpivot([], [*rules, "duplicate_key"], "violation", "n")


def observed(rows: DataFrame, rules: dict, name: str) -> tuple[DataFrame, Observation]:
    """rows, whose number and violations of rules are counted by the job that writes them; see broken."""
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    return rows.observe(seen, F.count("*").alias("n_rows"), *[F.count_if(v).alias(k) for k, v in rules.items()]), seen


def broken(seen: Observation) -> list[str]:
    """Every rule that the written rows broke, with the number of rows."""
    return [f"{k} ({n} rows)" for k, n in seen.get.items() if k != "n_rows" and n]


def matrix_report(matrix: DataFrame) -> DataFrame:
    """violation, n: the number of rows against each rule of the matrix contract, and of keys that occur twice."""
    return _report(matrix, matrix_rules(), MATRIX_KEY)


def require_matrix_columns(matrix: DataFrame) -> None:
    """Raises unless all columns of a matrix are there, and none off the ladder."""
    require(matrix, [*MATRIX_KEY, "tt_nearest", *ladder()], "matrix")
    extra = off_ladder(matrix.columns)
    if extra:
        raise ContractError("matrix: " + "; ".join(f"{c} is off the ladder" for c in extra))


def validate_matrix(matrix: DataFrame) -> DataFrame:
    """The matrix itself, or a ContractError that names every rule it breaks.  A matrix without rows is valid."""
    require(matrix, [*MATRIX_KEY, "tt_nearest", *ladder()], "matrix")
    extra = off_ladder(matrix.columns)
    found = [f"{r[0]} ({r[1]} rows)" for r in matrix_report(matrix).where("n > 0").collect()]
    if extra or found:
        raise ContractError("matrix: " + "; ".join([*found, *(f"{c} is off the ladder" for c in extra)]))
    return matrix


def gain_rules() -> dict:
    """name: a condition that holds for rows against the rule, for every rule of a gain row."""
    times, counts = ["time_gain_p1", "time_gain_p50"], [c for c in gain_columns() if c.startswith("count_")]
    bad_time, part = F.lit(False), F.lit(False)
    for c in times:
        bad_time = bad_time | (F.col(c).isNull() == F.coalesce(F.col("walk_available"), F.lit(False)))
    for c in counts:
        part = part | F.coalesce(F.col(c) != F.floor(c), F.lit(True))
    return {"mode": ~F.coalesce(F.col("mode") == "transit_gain", F.lit(False)), "time_gain": bad_time, "whole": part}


def gain_report(gains: DataFrame) -> DataFrame:
    """violation, n: the number of rows against each rule of the gains' contract, and of keys that occur twice."""
    return _report(gains, gain_rules(), ["batiment_id", "TYPEQU"])


def validate_gains(gains: DataFrame) -> DataFrame:
    require(gains, ["batiment_id", "TYPEQU", "mode", *gain_columns()], "transit gains")
    found = [f"{r[0]} ({r[1]} rows)" for r in gain_report(gains).where("n > 0").collect()]
    if found:
        raise ContractError("transit gains: " + "; ".join(found))
    return gains
