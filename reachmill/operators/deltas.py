"""Derived aggregates against a frozen snapshot: deltas, their classification and a report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import ContractError, require, require_none, require_unique

# Our column, the snapshot's column.
SNAPSHOT_MAP = {
    "nb_buildings": "nb_buildings",
    "share_alimentation": "share_food_c",
    "share_sante": "share_health_c",
    "share_administration": "share_admin_c",
    "share_ecole": "share_school_c",
    "share_banque": "share_bank_c",
    "avg_diversity": "avg_div_car",
    "avg_total": "avg_tot_car",
    "pct_iso_full": "pct_iso_full_c",
}
# Kind of band and its limit by metric family.
BANDS = {
    "share": ("abs", 0.10),
    "pct_iso_full": ("abs", 0.10),
    "avg_diversity": ("rel", 0.25),
    "avg_total": ("rel", 0.40),
    "nb_buildings": ("rel", 0.30),
}
WIDENED = ("avg_diversity", "avg_total")
# The types that were routed for the snapshot, and how its recorded list differs from them.
ROUTED_TYPES = [
    "D267", "A128", "A129", "A203", "A206", "A207", "A208", "A401", "A404", "A405", "A501", "A504", "B103", "B104", "B105", "B201", "B202", "B204", "B206", "B207",
    "B208", "B209", "B210", "B302", "B303", "B304", "B306", "B307", "B312", "B313", "B318", "B324", "B325", "C107", "C108", "C109", "C201", "C301", "C302", "C303",
    "D265", "D269", "D270", "D277", "D307", "D403", "D502", "F101", "F111", "F116", "F121", "F303", "F307",
]
DIVERGENCE = {"recorded_but_not_routed": ["C304", "C305"], "routed_but_not_recorded": ["F101"]}
#: What is known to have changed since the snapshot: the driver, the metrics that it moves, and which way (+1 up, 0 either).
DRIFT = [
    ("equipment of a later year", ["avg_diversity", "avg_total", "share_"], 1),
    ("origins are constructions, of known usage only", ["nb_buildings", "share_"], 0),
    ("origins stand at their address first", ["avg_diversity", "avg_total", "share_"], 0),
    ("listings are kept apart unless equal", ["avg_total", "share_"], 0),
    ("buildings of a later release", ["nb_buildings", "share_"], 0),
    ("streets of a later date", ["avg_diversity", "avg_total", "share_"], 0),
    ("a wider strip around the region", ["avg_diversity", "avg_total", "share_"], 1),
]


def drift_of(metric: str, gained: bool | None = None) -> list[str]:
    """The drivers that move a metric; only those that agree with its direction, where that is told."""
    return [name for name, moved, way in DRIFT if any(metric.startswith(m) for m in moved) and not (gained is False and way > 0)]


def require_findings(accepted: DataFrame) -> DataFrame:
    """Findings accepted before, (code_insee, metric, reason): all three filled, known metrics, one finding a row; else this raises."""
    require(accepted, ["code_insee", "metric", "reason"], "accepted findings")
    empty = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    require_none(accepted.where(empty("code_insee") | empty("metric") | empty("reason")).select("code_insee", "metric", "reason"), "accepted findings: empty value")
    require_none(accepted.where(~F.col("metric").isin(*SNAPSHOT_MAP)).select("metric"), "accepted findings: unknown metric")
    require_unique(accepted, ["code_insee", "metric"], "accepted findings")
    return accepted


def band_of(metric: str, bands=None):
    bands = bands or BANDS
    return bands.get("share" if metric.startswith("share_") else metric)


def granularity_prior(derived: DataFrame, snapshot: DataFrame) -> float | None:
    """Total buildings derived over total buildings of the snapshot."""
    a, b = derived.agg(F.sum("nb_buildings")).first()[0], snapshot.agg(F.sum("nb_buildings")).first()[0]
    return None if a is None or not b else float(a) / float(b)


def deltas(derived: DataFrame, snapshot: DataFrame, mapping=None, bands=None, ref_mode: str = "car", nb_prior: float | None = None, border=(), accepted: DataFrame | None = None, strict: bool = False) -> DataFrame:
    """code_insee, nom_commune, metric, snapshot, derived, delta_abs, delta_rel, classification.

    Both sides are unpivoted and joined in full; the first rule that holds
    decides: absent from the snapshot, absent from the derivation, accepted
    before, the building count's own band around the prior, no band, within the
    band, a border commune that gained, else a flag.  Reasons carry the change and
    the band in whole percent, or the words of the finding that was ``accepted``
    (see require_findings).  A mode that isn't there raises when strict, and leaves
    every comparison missing otherwise.
    """
    mapping = mapping or SNAPSHOT_MAP
    require(derived, ["code_insee", "mode", *mapping], "derived aggregates")
    require(snapshot, ["code_insee", "nom_commune", *mapping.values()], "snapshot")
    own = derived.where(F.col("mode") == ref_mode)
    if strict and not own.limit(1).count():
        raise ContractError(f"derived aggregates have no mode {ref_mode}")
    if nb_prior is None:
        nb_prior = granularity_prior(own, snapshot)
    ours = own.select("code_insee", *[F.col(c).cast("double").alias(c) for c in mapping]).unpivot(["code_insee"], list(mapping), "metric", "derived")
    theirs = snapshot.select("code_insee", *[F.col(b).cast("double").alias(a) for a, b in mapping.items()]).unpivot(["code_insee"], list(mapping), "metric", "snapshot")
    rows = ours.join(theirs, ["code_insee", "metric"], "full").join(snapshot.select("code_insee", "nom_commune").distinct(), "code_insee", "left")
    rows = rows.withColumn("delta_abs", F.col("derived") - F.col("snapshot")).withColumn("delta_rel", F.when(F.col("snapshot") != 0, F.col("delta_abs") / F.col("snapshot")))
    if accepted is not None:
        rows = rows.join(require_findings(accepted).select("code_insee", "metric", F.col("reason").alias("_finding")), ["code_insee", "metric"], "left")
    else:
        rows = rows.withColumn("_finding", F.lit(None).cast("string"))
    metric, within, banded = F.col("metric"), F.lit(False), F.lit(False)
    for name in mapping:
        band = band_of(name, bands)
        if band and name != "nb_buildings":
            size = F.abs(F.col("delta_abs" if band[0] == "abs" else "delta_rel"))
            within = within | ((metric == name) & F.coalesce(size <= band[1], F.lit(False)))
            banded = banded | (metric == name)
    count = metric == "nb_buildings"
    prior = F.lit(nb_prior).cast("double")
    near = F.coalesce(F.abs(F.try_divide("derived", "snapshot") - prior) / prior <= band_of("nb_buildings", bands)[1], F.lit(False))
    widened = metric.isin(*WIDENED) & F.coalesce(F.col("code_insee").isin(*border), F.lit(False)) & F.coalesce(F.col("delta_rel") > 0, F.lit(False))
    kind = (
        F.when(F.col("snapshot").isNull() | F.col("derived").isNull(), "missing").when(F.col("_finding").isNotNull(), "expected").when(count, F.when(near, "expected").otherwise("flag"))
        .when(~banded, "flag").when(within, "expected").when(widened, "expected").otherwise("flag")
    )
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    percent = lambda c: F.round(100 * c).cast("long").cast("string")
    signed = lambda c: F.concat(F.when(F.round(100 * c) > 0, "+").otherwise(""), percent(c))
    change, limit = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name in mapping:
        band = band_of(name, bands)
        if band:
            relative = band[0] == "rel"
            size = text(signed(F.col("delta_rel" if relative else "delta_abs")), " %" if relative else " points")
            change = F.when(metric == name, F.coalesce(size, F.lit("from zero"))).otherwise(change)
            limit = F.when(metric == name, F.lit(f"{round(100 * band[1])} {'%' if relative else 'points'}")).otherwise(limit)
    ratio = F.coalesce(text(percent(F.try_divide("derived", "snapshot")), " %"), F.lit("from zero"))
    cause = (
        F.when(F.col("snapshot").isNull(), "absent from the snapshot").when(F.col("derived").isNull(), "not derived").when(F.col("_finding").isNotNull(), text("accepted before: ", F.col("_finding")))
        .when(count, text(ratio, " of the snapshot, ", F.when(near, "within ").otherwise("beyond "), limit, " around the prior of ", percent(prior), " %")).when(~banded, "no band")
        .when(within, text("within ", limit, ": ", change)).when(widened, text("beyond ", limit, ", a border commune that gained: ", change)).otherwise(text("beyond ", limit, ": ", change))
    )
    return rows.select("code_insee", "nom_commune", "metric", "snapshot", "derived", "delta_abs", "delta_rel", kind.alias("classification"), cause.alias("reason"))


def delta_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("metric", "classification").agg(F.count("*").alias("n"))


def render_report(found: DataFrame, title: str = "Deltas against the snapshot") -> str:
    """A Markdown report: counts by metric, all flagged rows and all missing comparisons.  Unclassified rows raise."""
    if found.where("classification is null or reason is null").limit(1).count():
        raise ContractError("report: unclassified rows")
    out = [f"# {title}", "", "| metric | expected | flag | missing |", "|---|---|---|---|"]
    table = found.groupBy("metric").pivot("classification", ["expected", "flag", "missing"]).count().fillna(0).orderBy("metric")
    out += [f"| {r.metric} | {r.expected} | {r.flag} | {r.missing} |" for r in table.collect()]
    flags, missing = (found.where(F.col("classification") == kind).orderBy("code_insee", "metric").toLocalIterator() for kind in ("flag", "missing"))
    out += ["", "## Flags", ""] + [f"- {r.code_insee} {r.nom_commune or ''}: {r.metric} {r.snapshot:g} to {r.derived:g} ({r.reason})" for r in flags]
    out += ["", "## Missing", ""] + [f"- {r.code_insee} {r.nom_commune or ''}: {r.metric} ({r.reason})" for r in missing]
    out += ["", "## What moves the metrics", "", "| metric | drivers |", "|---|---|"] + [f"| {m} | {'; '.join(drift_of(m))} |" for m in SNAPSHOT_MAP if drift_of(m)]
    return "\n".join(out) + "\n"
