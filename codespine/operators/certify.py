"""Certification of published releases against their manifests, all releases of a store in one plan; coverage and history of their sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .diff import snapshot_diff
from .validate import blank

#: The levels of a release, the parent level and its column by level, the columns that only fractions and items fill, the facts that release and manifest share.
LEVELS = ("hs2", "hs4", "hs6", "fraccion8", "nico10")
PARENTS = {"hs4": ("hs2", "hs4_without_hs2"), "hs6": ("hs4", "hs6_without_hs4"), "fraccion8": ("hs6", "fraction_without_hs6"), "nico10": ("fraccion8", "nico_without_fraction")}
VALUES = ("values_from_level", "unit_code", "unit_name", "igi_text", "igi_kind", "igi_value", "ige_text", "ige_kind", "ige_value")
FACTS = ("schema_version", "ligie_version", "effective_as_of", "validation_status")
CHANGES = ("added", "removed", "updated")


class CertificationError(ValueError):
    """A release that isn't what its manifest says."""


def _when(condition: Column, n: Column | int = 1) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), n if isinstance(n, Column) else F.lit(n)).otherwise(0).cast("bigint")


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def problems(records: DataFrame, releases: DataFrame, manifests: DataFrame) -> DataFrame:
    """``dataset_version``, ``problem``, ``n`` of every release that isn't as it should be; a release without problems has no rows.

    ``manifests``: ``dataset_version``, the facts above, ``row_count`` and ``level_counts`` map<string,bigint>; ``releases``: the same without levels;
    ``records``: public records with their ``dataset_version``. A version that any of the three lacks has ``no_manifest``, ``release_rows`` (there is to be
    one) or ``no_records``. Records are counted once for all releases, by partial sums, so that a release may hold most rows; parents are
    one anti join by version, level, code and law version. Null versions form one release of their own.
    """
    low, tariff = F.col("level").isin("hs2", "hs4", "hs6"), F.col("level").isin("fraccion8", "nico10")
    n_of = lambda c: F.count(F.when(c, 1))
    counted = records.groupBy("dataset_version").agg(
        F.count("*").alias("n"), F.count_distinct("record_id").alias("ids"), n_of(blank("record_id")).alias("blank_ids"),
        n_of(low & _any([F.col(c).isNotNull() for c in VALUES if c in records.columns])).alias("hs_values"), n_of(tariff & ~F.col("values_from_level").eqNullSafe(F.lit("fraccion8"))).alias("tariff_origin"),
        *[n_of(F.col("level") == v).alias(f"n_{v}") for v in LEVELS],
    )
    shown = releases.groupBy("dataset_version").agg(F.count("*").alias("releases"), *[F.max(c).alias(f"r_{c}") for c in (*FACTS, "row_count")])
    told = manifests.select("dataset_version", F.lit(True).alias("m"), *[F.col(c).alias(f"m_{c}") for c in (*FACTS, "row_count", "level_counts")])

    def named(df: DataFrame, name: str) -> DataFrame:
        return df.withColumnRenamed("dataset_version", name)

    def both(left: DataFrame, right: DataFrame) -> DataFrame:
        out = left.join(named(right, "_v"), F.col("dataset_version").eqNullSafe(F.col("_v")), "full")
        return out.withColumn("dataset_version", F.coalesce("dataset_version", "_v")).drop("_v")

    every = both(both(counted, shown), told)
    here, one, manifest = F.col("n").isNotNull(), F.coalesce("releases", F.lit(0)) == 1, F.col("m").isNotNull()
    levels = F.col("m_level_counts")
    known = F.array_sort(F.map_keys(levels)).eqNullSafe(F.array_sort(F.array(*map(F.lit, LEVELS))))
    whole = F.aggregate(F.map_values(levels), F.lit(0).cast("bigint"), lambda a, x: a + F.coalesce(x, F.lit(0))) == F.col("m_row_count")
    as_told = F.array_size(F.filter(F.array(*[F.try_element_at(levels, F.lit(v)).eqNullSafe(F.col(f"n_{v}")) for v in LEVELS]), lambda x: ~x)) == 0
    found = {
        "no_records": _when(~here), "no_manifest": _when(~manifest), "release_rows": _when(~one, F.coalesce("releases", F.lit(0))),
        "not_validated": _when(one & ~F.col("r_validation_status").eqNullSafe(F.lit("passed"))),
        "metadata_mismatch": F.when(one & manifest, sum((_when(~F.col(f"r_{c}").eqNullSafe(F.col(f"m_{c}"))) for c in FACTS), F.lit(0))).otherwise(0).cast("bigint"),
        "row_count_mismatch": _when(here & manifest & one & ~(F.col("n").eqNullSafe(F.col("m_row_count")) & F.col("n").eqNullSafe(F.col("r_row_count")))),
        "level_counts_mismatch": _when(here & manifest & ~(known & F.coalesce(whole, F.lit(False)) & as_told)),
        "duplicate_record_ids": _when(here, F.col("n") - F.col("ids")), "blank_record_ids": _when(here, F.col("blank_ids")),
        "hs_values": _when(here, F.col("hs_values")), "tariff_origin": _when(here, F.col("tariff_origin")),
    }
    # a version that a table lacks counts once, so that it is a row, too
    found["release_rows"] = F.when(found["release_rows"] == 0, _when(~one)).otherwise(found["release_rows"])
    lines = F.array(*[F.struct(F.lit(name).alias("problem"), n.alias("n")) for name, n in found.items()])
    own = every.select("dataset_version", F.explode(F.filter(lines, lambda x: x["n"] > 0)).alias("x")).select("dataset_version", "x.*")
    return own.unionByName(orphans(records).groupBy("dataset_version", "problem").agg(F.count("*").alias("n")))


def orphans(records: DataFrame) -> DataFrame:
    """``dataset_version``, ``problem``, ``code`` of current records whose parent of the level above isn't current in the same release and law version.

    A record without the parent's code or without a law version has no parent.
    """
    current = records.where("is_current")
    up = F.coalesce(*[F.when(F.col("level") == level, F.struct(F.lit(parent).alias("level"), F.col(parent).alias("code"), F.lit(name).alias("problem"))) for level, (parent, name) in PARENTS.items()])
    below = current.select("dataset_version", "ligie_version", "code", up.alias("_up")).where("_up IS NOT NULL")
    above = current.select(F.col("dataset_version").alias("_v"), F.col("ligie_version").alias("_l"), F.col("level").alias("_level"), F.col("code").alias("_code"))
    same = F.col("dataset_version").eqNullSafe(F.col("_v")) & (F.col("ligie_version") == F.col("_l")) & (F.col("_up.level") == F.col("_level")) & (F.col("_up.code") == F.col("_code"))
    return below.join(above, same, "left_anti").select("dataset_version", F.col("_up.problem").alias("problem"), "code")


def certification(records: DataFrame, releases: DataFrame, manifests: DataFrame) -> DataFrame:
    """``dataset_version``, ``publishable`` and ``problems`` (sorted names) of every version that any of the three tables knows."""
    found = problems(records, releases, manifests).groupBy("dataset_version").agg(F.array_sort(F.collect_set("problem")).alias("problems"))  # kinds are few
    versions = reduce(DataFrame.union, [df.select("dataset_version") for df in (records, releases, manifests)]).distinct()
    out = versions.alias("a").join(found.alias("b"), F.col("a.dataset_version").eqNullSafe(F.col("b.dataset_version")), "left")
    return out.select("a.dataset_version", F.col("problems").isNull().alias("publishable"), F.coalesce("problems", F.array().cast("array<string>")).alias("problems"))


def require(records: DataFrame, releases: DataFrame, manifests: DataFrame) -> None:
    """Raises for the first release, by version, that has problems."""
    if bad := certification(records, releases, manifests).where("NOT publishable").orderBy("dataset_version").head(1):
        raise CertificationError(f"{bad[0].dataset_version}: {', '.join(bad[0].problems)}")


def nico_coverage(records: DataFrame, lagging: DataFrame) -> DataFrame:
    """Of each release's current fractions: ``fraccion8``, ``with_nico_descendant``, ``missing_nico_descendant``, ``known_upstream_lag``, ``unclassified_missing``.

    ``lagging`` (``code``) are fractions whose items are known to come later. Repeated codes count once.
    """
    current = records.where("is_current")
    fractions = current.where("level = 'fraccion8'").select("dataset_version", "code").distinct()
    items = current.where("level = 'nico10' AND fraccion8 IS NOT NULL").select(F.col("dataset_version").alias("_v"), F.col("fraccion8").alias("_code"), F.lit(True).alias("_some")).distinct()
    late = lagging.select(F.col("code").alias("_late")).where("_late IS NOT NULL").distinct()
    rows = fractions.join(items, F.col("dataset_version").eqNullSafe(F.col("_v")) & (F.col("code") == F.col("_code")), "left").join(late, F.col("code") == F.col("_late"), "left")
    some, known = F.col("_some").isNotNull(), F.col("_late").isNotNull()
    n_of = lambda c: F.count(F.when(c, 1))
    return rows.groupBy("dataset_version").agg(
        F.count("*").alias("fraccion8"), n_of(some).alias("with_nico_descendant"), n_of(~some).alias("missing_nico_descendant"),
        n_of(~some & known).alias("known_upstream_lag"), n_of(~some & ~known).alias("unclassified_missing"),
    )


KEY = ["dataset_key", "document_role"]


def source_history(previous: DataFrame, current: DataFrame, values: list[str]) -> DataFrame:
    """``change``, the key, and both states (``previous``, ``current``: key and ``values``; null where there is none) of sources that are new, gone or changed."""
    found = snapshot_diff(previous, current, KEY, values)
    state = lambda side, gone: F.when(F.col("change") != gone, F.struct(*KEY, *[F.col(f"{side}_{v}").alias(v) for v in values]))
    return found.select("change", *KEY, state("previous", "added").alias("previous"), state("current", "removed").alias("current"))


def history_problems(history: DataFrame, identities: DataFrame, values: list[str]) -> DataFrame:
    """The key and ``reason`` of entries of a history that can't be right: ``change`` (of unknown kind), ``key`` (blank), ``states`` (that don't go with the change),
    ``identity`` (a state of another key), ``current`` (not the release's identity of that key)."""
    was, now, change = F.col("previous").isNotNull(), F.col("current").isNotNull(), F.col("change")
    told = identities.select(*[F.col(k).alias(f"_{k}") for k in KEY], F.struct(*KEY, *values).alias("_identity"))
    rows = history.join(told, [F.col(k) == F.col(f"_{k}") for k in KEY], "left")
    states = F.when(change == "added", ~was & now).when(change == "removed", was & ~now).when(change == "updated", was & now)
    other = [F.col(side).isNotNull() & ~F.col(f"{side}.{k}").eqNullSafe(F.col(k)) for side in ("previous", "current") for k in KEY]
    differs = _any([~F.col(f"current.{c}").eqNullSafe(F.col(f"_identity.{c}")) for c in (*KEY, *values)]) | F.col("_identity").isNull()
    reasons = F.array_compact(F.array(
        F.when(~F.coalesce(change.isin(*CHANGES), F.lit(False)), "change"), F.when(_any([blank(k) for k in KEY]), "key"),
        F.when(~F.coalesce(states, F.lit(True)), "states"), F.when(_any(other), "identity"), F.when(now & differs, "current"),
    ))
    return rows.select(*KEY, F.explode(reasons).alias("reason"))
