"""Publishing: dense statistics of the address table by level, with labels, names and coverage, and a document about them."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import LEVELS, PROBS, ContractError, require_none, require_unique
from reachmill.operators import aggregates
from reachmill.operators.monolith import publish_names
from reachmill.operators.routing import table_fingerprint
from reachmill.sources import io
from reachmill.sources.lineage import cut


def located_spine(addresses: DataFrame, territories: DataFrame, communes: DataFrame, strict: bool = True) -> DataFrame:
    """address_id with all territory columns of its commune: the join keeps every address exactly once (raises when strict)."""
    rows = addresses.select("address_id").join(territories.select("address_id", "code_insee"), "address_id").join(communes, "code_insee")
    if strict:
        require_unique(rows, ["address_id"], "address spine")
        require_none(addresses.select("address_id").join(rows.select("address_id"), "address_id", "left_anti"), "address outside of every commune")
    return rows


def labelled_types(types: DataFrame, labels: DataFrame, strict: bool = True) -> DataFrame:
    """TYPEQU, nom_typequ of the catalogue; repeated labels and types without one raise when strict."""
    if strict:
        require_unique(labels, ["TYPEQU"], "labels")
    rows = types.select("TYPEQU").where("TYPEQU is not null and TYPEQU <> ''").distinct().join(labels.select("TYPEQU", "nom_typequ"), "TYPEQU", "left")
    if strict:
        require_none(rows.where("nom_typequ is null").select("TYPEQU"), "type without a label")
    return rows


def level_tables(metrics: DataFrame, spine: DataFrame, types: DataFrame, labels: DataFrame, axes: dict[str, DataFrame], value_columns, probs=PROBS, strict: bool = True, stored=None) -> dict[str, DataFrame]:
    """The published table of each level of axes, all from one pass over the metrics: every territory of the axis by every labelled type.

    The territories of the spine must be among those of the axis (raises when strict).
    """
    if strict:
        for level, axis in axes.items():
            keys = LEVELS[level]
            require_none(spine.select(*keys).dropna("any").distinct().join(axis.select(*keys).distinct(), keys, "left_anti"), f"{level}: a territory that is not on the axis")
    names = labelled_types(types, labels, strict)
    levels = {level: LEVELS[level] for level in axes}
    finest = LEVELS["commune"][0]
    stats = aggregates.dense_levels(metrics, spine, names, value_columns, levels, probs, stored, finest if finest in spine.columns else None)
    out = {}
    for level, keys in levels.items():
        table = aggregates.publish_axis(stats[level], axes[level], names, keys).join(names, "TYPEQU")
        out[level] = table.withColumnsRenamed({a: b for a, b in publish_names(table.columns).items() if a != b})
    return out


def level_table(metrics: DataFrame, spine: DataFrame, types: DataFrame, labels: DataFrame, axis: DataFrame, level: str, value_columns, probs=PROBS, strict: bool = True) -> DataFrame:
    """level_tables of one level."""
    return level_tables(metrics, spine, types, labels, {level: axis}, value_columns, probs, strict)[level]


def publish(metrics: DataFrame, spine: DataFrame, types: DataFrame, labels: DataFrame, axes: dict[str, DataFrame], value_columns, folder: str, probs=PROBS, source: dict | None = None) -> dict:
    """Writes a table for each level of axes, in order of its keys, and metadata.json; returns the latter.

    The metrics are read once for all levels.  A table whose number of rows
    isn't territories by types raises before the document is written.
    """
    n_types, levels = labelled_types(types, labels).count(), {}
    for level, table in level_tables(metrics, spine, types, labels, axes, value_columns, probs, stored=cut).items():
        keys, path = LEVELS[level], os.path.join(folder, level)
        io.write_table(table, path, [*keys, "TYPEQU"])
        back = metrics.sparkSession.read.parquet(path)
        n, territories = back.count(), axes[level].select(*keys).distinct().count()
        if n != territories * n_types:
            raise ContractError(f"{level}: {n} rows for {territories} territories and {n_types} types")
        require_unique(back, [*keys, "TYPEQU"], level)
        by = {r[0]: r[1] for r in back.groupBy("coverage_status").count().collect()}
        levels[level] = {"keys": keys, "n_rows": n, "n_territories": territories, "coverage": by, "content_key": table_fingerprint(back).first()[0]}
    document = {"kind": "published_levels", "n_types": n_types, "probs": list(probs), "metrics": list(value_columns), "levels": levels, "source": source or {}}
    io.write_json(document, os.path.join(folder, "metadata.json"))
    return document
