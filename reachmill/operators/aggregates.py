"""Dense territory x type statistics over sparse metrics, whose absent rows are zeros.

The table meets the spine once, with its metrics as columns; only then are they
turned into rows and counted, where they stand, into one histogram of (territory,
type, metric, value).  Grouping sets over that histogram give all levels at once,
so the table is scanned once whatever the number of metrics and levels.

Absent rows are zeros.  They are in the histogram from the start: every address
of a territory weighs one at zero for each type and metric, and every observed
value takes one off there again, so no second pass has to learn how many zeros
were left out.  Quantiles are exact.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reachmill.functions.contracts import LEVELS, PROBS, ContractError, assert_probs, require, require_none, require_unique, stat_suffixes, type_catalogue


def implicit_zero_quantiles(values: DataFrame, keys, totals: DataFrame, probs=PROBS, value: str = "value", weight: str = "weight") -> DataFrame:
    """keys and p10.. columns: type-7 quantiles of values with weights among n_total, absent ones 0.

    Null values, weights that are null, negative or no whole numbers, and
    weights that sum to more than n_total raise when the result is made.
    """
    probs = assert_probs(probs)
    sound = F.col(value).isNotNull() & F.coalesce((F.col(weight) >= 0) & (F.col(weight) == F.floor(weight)), F.lit(False))
    values = values.withColumn(weight, F.when(sound, F.col(weight)).otherwise(F.raise_error(F.lit("quantiles: null value, or a weight that is no whole number"))))
    seen = values.groupBy(*keys).agg(F.sum(weight).alias("seen"))
    left = F.col("n_total") - F.coalesce("seen", F.lit(0))
    left = F.when(left >= 0, left).otherwise(F.raise_error(F.lit("quantiles: weights sum to more than n_total")))
    zeros = totals.join(seen, list(keys), "left").select(*keys, F.lit(0.0).alias(value), left.cast("long").alias(weight))
    rows = values.select(*keys, F.col(value).cast("double").alias(value), F.col(weight).cast("long").alias(weight)).unionByName(zeros.where(F.col(weight) > 0))
    q = F.percentile(value, F.array(*[F.lit(p) for p in probs]), F.col(weight))
    return rows.groupBy(*keys).agg(q.alias("q")).select(*keys, *[F.col("q")[i].alias(f"p{round(100 * p):g}") for i, p in enumerate(probs)])


def _counted(metrics: DataFrame, spine: DataFrame, keys, value_columns) -> DataFrame:
    """keys, TYPEQU, metric, value, weight: the metrics are turned into rows after the join, so that they go through its shuffle as columns."""
    wide = metrics.select("address_id", "TYPEQU", *[F.col(c).cast("double").alias(c) for c in value_columns])
    located = wide.join(spine.select("address_id", *keys), "address_id").drop("address_id")
    long = located.unpivot([*keys, "TYPEQU"], list(value_columns), "metric", "value").where("value is not null")
    return long.groupBy(*keys, "TYPEQU", "metric", "value").agg(F.count("*").alias("weight"))


def histogram(metrics: DataFrame, spine: DataFrame, keys, value_columns) -> DataFrame:
    """keys, TYPEQU, metric, value, weight over the rows whose address is known; null values are left out."""
    return _counted(metrics, spine, list(keys), value_columns)


#: More types than this are no catalogue: the grid of territories by types would outgrow the data.
MOST_TYPES = 100_000


def type_names(types: DataFrame) -> list[str]:
    """The sorted catalogue of types; one that isn't a catalogue by its size raises."""
    names = sorted(r[0] for r in type_catalogue(types).limit(MOST_TYPES + 1).collect())
    if len(names) > MOST_TYPES:
        raise ContractError(f"more than {MOST_TYPES} types")
    return names


def level_histogram(metrics: DataFrame, spine: DataFrame, names, value_columns, levels, finest: str | None = None) -> DataFrame:
    """level, all keys (null where a level doesn't have them), TYPEQU, metric, value, weight, observed: dense, with absent rows at value 0.

    ``observed`` is how much of the weight comes from values that are there.
    Territories with a null key part are left out.  Addresses whose finest key
    (the first of the first level, unless told) is null count in coarser levels, with no values.
    """
    every = list(dict.fromkeys(c for keys in levels.values() for c in keys))
    lists = lambda values: F.explode(F.array(*[F.lit(v) for v in values]))
    seen = _counted(metrics.where(F.col("TYPEQU").isin(names)), spine.where(F.col(finest or every[0]).isNotNull()), every, value_columns)
    both = F.array(F.struct("value", F.col("weight").alias("w"), F.col("weight").alias("o")), F.struct(F.lit(0.0).alias("value"), (-F.col("weight")).alias("w"), F.lit(0).cast("long").alias("o")))
    seen = seen.withColumn("e", F.explode(both)).select(*every, "TYPEQU", "metric", "e.value", "e.w", "e.o")
    grid = spine.groupBy(*every).agg(F.count("*").alias("w")).withColumn("TYPEQU", lists(names)).withColumn("metric", lists(value_columns))
    grid = grid.select(*every, "TYPEQU", "metric", F.lit(0.0).alias("value"), "w", F.lit(0).cast("long").alias("o"))
    by = [*every, "TYPEQU", "metric", "value"]
    sets = [[*keys, "TYPEQU", "metric", "value"] for keys in levels.values()]
    summed = seen.unionByName(grid).groupingSets([[F.col(c) for c in one] for one in sets], *by).agg(F.grouping_id().alias("_set"), F.sum("w").alias("weight"), F.sum("o").alias("observed"))
    number = lambda keys: sum(1 << (len(by) - 1 - i) for i, c in enumerate(by) if c in every and c not in keys)
    level, known = F.lit(None).cast("string"), F.lit(False)
    for name, keys in levels.items():
        of = F.col("_set") == number(keys)
        level = F.when(of, name).otherwise(level)
        known = known | (of & reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys]))
    return summed.where(known & (F.col("weight") > 0)).select(level.alias("level"), *by, "weight", "observed")


def level_statistics(hist: DataFrame, value_columns, probs=PROBS) -> DataFrame:
    """One row for each level, territory and type of a level_histogram: n_addresses, n_observed and all statistics of all metrics."""
    value_columns = list(value_columns)
    by = [c for c in hist.columns if c not in ("metric", "value", "weight", "observed")]
    v, w = F.col("value"), F.col("weight")
    dealt = hist.repartition(*by)  # once: both aggregations below keep to it
    n = F.sum(w)
    stats = dealt.groupBy(*by, "metric").agg(
        n.alias("n"), F.sum("observed").alias("seen"), (F.sum(v * w) / n).alias("mean"), F.percentile(v, F.array(*[F.lit(p) for p in probs]), w).alias("q"),
        F.greatest(F.lit(0.0), F.max(v)).alias("max"), (F.sum(F.when(v > 0, w).otherwise(0)) / n).alias("share"),
    )
    of = lambda c: F.first(F.when(F.col("metric") == c, F.struct("seen", "mean", "q", "max", "share")), ignorenulls=True)
    wide = stats.groupBy(*by).agg(F.max("n").alias("n_addresses"), *[of(c).alias(f"_{c}") for c in value_columns])
    out = [F.col(f"_{value_columns[0]}")["seen"].cast("long").alias("n_observed")]
    for c in value_columns:
        s = F.col(f"_{c}")
        columns = [s["mean"], *[s["q"][i] for i in range(len(probs))], s["max"], s["share"]]
        out += [x.alias(f"{c}_{name}") for x, name in zip(columns, stat_suffixes(probs))]
    return wide.select(*by, "n_addresses", *out)


def dense(metrics: DataFrame, spine: DataFrame, types: DataFrame, keys, value_columns, probs=PROBS, strict: bool = False) -> DataFrame:
    """Statistics for every (territory, type); territories with a null key part are left out."""
    probs, keys = assert_probs(probs), list(keys)
    require(spine, ["address_id", *keys], "address spine")
    if strict:
        require_unique(metrics, ["address_id", "TYPEQU"], "metrics")
        require_none(metrics.join(types, "TYPEQU", "left_anti").select("TYPEQU"), "unknown type")
        require_none(metrics.join(spine, "address_id", "left_anti").select("address_id"), "unknown address")
        null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in value_columns])
        require_none(metrics.where(null).select("address_id", "TYPEQU"), "null metric")
    return dense_levels(metrics, spine.dropna("any", subset=keys), types, value_columns, {"": keys}, probs)[""]


def dense_levels(metrics: DataFrame, spine: DataFrame, types: DataFrame, value_columns, levels=None, probs=PROBS, stored=None, finest: str | None = None) -> dict[str, DataFrame]:
    """The same for several levels from one histogram: level name to table.

    ``stored`` (a function of a table that gives it back from where it wrote it)
    keeps the statistics of all levels, so that what reads several of them
    doesn't make them anew.
    """
    levels, probs = levels or LEVELS, assert_probs(probs)
    stats = level_statistics(level_histogram(metrics, spine, type_names(types), list(value_columns), levels, finest), value_columns, probs)
    stats = stored(stats) if stored else stats
    every = {c for keys in levels.values() for c in keys}
    return {level: stats.where(F.col("level") == level).drop("level", *(every - set(keys))) for level, keys in levels.items()}


def publish_axis(stats: DataFrame, axis: DataFrame, types: DataFrame, keys) -> DataFrame:
    """Every territory of the axis with every type: counts 0 and statistics null where there is no address, and a coverage status."""
    by = [*keys, "TYPEQU"]
    full = axis.select(*keys).distinct().withColumn("TYPEQU", F.explode(F.array(*[F.lit(n) for n in type_names(types)])))
    out = full.join(stats, by, "left").withColumn("n_addresses", F.coalesce("n_addresses", F.lit(0))).withColumn("n_observed", F.coalesce("n_observed", F.lit(0)))
    status = F.when(F.col("n_addresses") == 0, "no_address").when(F.col("n_observed") == 0, "no_observation").otherwise("observed")
    return out.withColumn("coverage_status", status)


def same_set(a: DataFrame, b: DataFrame, what: str) -> None:
    """Raises unless both hold the same distinct rows."""
    for x, y in ((a, b), (b, a)):
        if x.exceptAll(y.distinct()).join(y.distinct(), y.columns, "left_anti").limit(1).count():
            raise ContractError(f"{what}: the sets differ")
