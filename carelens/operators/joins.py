"""Joins: geography, keyed enrichment of the register, conditional anti join, key audits."""

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelens.functions.keys import canonical_key, commune_key, lit, named, ref
from carelens.operators.clean import filter_in_list
from carelens.operators.skew import HEAVY_ROWS, enrich_by_key

# A side is broadcast only if its inputs are known to be below this size; beyond it Spark shuffles both sides.
BROADCAST_BYTES = 16 * 1024 * 1024


def plan_bytes(df: DataFrame) -> int | None:
    """Size the optimizer knows for a frame (file sizes after pruning); None where it cannot be asked."""
    try:
        plan = df._jdf.queryExecution().optimizedPlan()
    except AttributeError:
        return None
    return int(plan.stats().sizeInBytes())


def broadcast_when_small(df: DataFrame, inputs: Iterable[DataFrame], limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for a frame built from small inputs; without proof of size the choice is left to Spark.

    The inputs are what is measured: the optimizer multiplies sizes across joins, so the frame's own estimate says
    nothing about a look-up table joined to its parents.
    """
    sizes = [plan_bytes(i) for i in inputs]
    if any(s is None for s in sizes) or sum(sizes) > limit:
        return df
    return F.broadcast(df)


def hierarchy_fallback(communes: DataFrame) -> DataFrame:
    """Communes with their department; one without a region takes the department of its parent commune."""
    kinds = dict(communes.dtypes)
    coded = communes.selectExpr(
        named(commune_key("com", kinds["com"]), "com"),
        named(canonical_key("dep", kinds["dep"]), "dep"),
        "reg",
        "ncc",
        named(commune_key("comparent", kinds["comparent"]), "comparent"),
    )
    direct = coded.where("reg IS NOT NULL").select("com", "dep", "ncc")
    children = coded.where("reg IS NULL AND com <> comparent").select("com", "ncc", "comparent")
    parents = coded.where("dep IS NOT NULL").selectExpr("com AS comparent", "dep")
    inherited = children.join(broadcast_when_small(parents, [communes]), "comparent", "left")
    return direct.unionByName(inherited.select("com", "dep", "ncc"))


def geography(
    communes: DataFrame, departments: DataFrame, regions: DataFrame, codes: Iterable[int] | DataFrame | None = None
) -> DataFrame:
    """Commune → department → region in one look-up; with ``codes`` only the communes of those regions.

    ``codes`` may be a frame with a column ``code``, which is joined instead of being listed in the plan.
    """
    how = "left" if codes is None else "inner"
    if isinstance(codes, DataFrame):
        wanted = broadcast_when_small(codes.selectExpr("code AS __code"), [codes])
        known = regions.join(wanted, F.expr("reg = __code"), "left_semi")
    else:
        known = regions if codes is None else filter_in_list(regions, "reg", codes)
    known = known.selectExpr("reg AS region_code", "ncc AS region_name")
    dep_key = canonical_key("dep", dict(departments.dtypes)["dep"])
    named_deps = departments.selectExpr(named(dep_key, "dep_code"), "ncc AS dep_name", "reg AS dep_region")
    placed = named_deps.join(
        broadcast_when_small(known, [regions]), F.expr("dep_region = region_code"), how
    ).drop("dep_region")
    coded = hierarchy_fallback(communes).withColumnRenamed("ncc", "commune_name")
    placed = broadcast_when_small(placed, [departments, regions])
    return coded.join(placed, F.expr("dep = dep_code"), how).drop("dep")


def geo_enrich(
    fact: DataFrame,
    communes: DataFrame,
    departments: DataFrame,
    regions: DataFrame,
    key: str = "com_code",
    codes: Iterable[int] | DataFrame | None = None,
) -> DataFrame:
    """Add commune, department and region to rows holding a commune code.

    Asking for regions filters the look-up first and joins it inner, so rows of other regions never reach a shuffle.
    """
    places = geography(communes, departments, regions, codes).withColumnRenamed("com", key)
    places = broadcast_when_small(places, [communes, departments, regions])
    return fact.join(places, key, "left" if codes is None else "inner")


def star_enrich(
    fact: DataFrame,
    sides: Mapping[str, tuple[DataFrame, str, list[str]]],
    key: str = "finess",
    skew_check: str = "auto",
    min_rows: int = HEAVY_ROWS,
) -> DataFrame:
    """LEFT JOIN every side (frame, key column, columns to take) on one key of the fact.

    All sides share the fact's key, so the fact is shuffled at most once however many sides there are; keys that hold very
    many rows of the fact or of a side are joined over a grid of tasks (``enrich_by_key``).
    """
    taken = {name: frame.selectExpr(named(ref(own), key), *map(ref, columns)) for name, (frame, own, columns) in sides.items()}
    return enrich_by_key(fact, taken, {}, key, [fact, *taken.values()], skew_check, min_rows)


def expr_key_join(
    fact: DataFrame, side: DataFrame, computed: str, key: str = "finess", skew_check: str = "auto", min_rows: int = HEAVY_ROWS
) -> DataFrame:
    """LEFT JOIN a side whose key has to be computed; the key becomes a column so the join stays an equi-join.

    Heavy keys go the way of ``star_enrich``.
    """
    keyed = side.selectExpr("*", named(computed, key))
    return enrich_by_key(fact, {"side": keyed}, {}, key, [fact, keyed], skew_check, min_rows)


def anti_join_when(left: DataFrame, excluded: DataFrame, key: str, condition: str) -> DataFrame:
    """Drop the rows that meet a condition and whose key is listed; a NULL key or NULL condition keeps the row.

    The list is reduced to its distinct keys before it meets the rows.
    """
    listed = excluded.selectExpr(named(ref(key), "listed_key")).distinct()
    return left.join(listed, F.expr(f"{ref(key)} = listed_key AND ({condition})"), "left_anti")


def attach_signals(
    facilities: DataFrame, complaints: DataFrame, incidents: DataFrame | None = None, key: str = "finess"
) -> DataFrame:
    """Add the per-establishment complaint figures and, where given, incident figures."""
    enriched = facilities.join(complaints, key, "left")
    return enriched if incidents is None else enriched.join(incidents, key, "left")


def fanout_audit(dimensions: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Keys a dimension holds more than once, i.e. the rows a LEFT JOIN on it would multiply."""
    keys = [
        frame.selectExpr(f"{lit(name)} AS dimension", f"CAST({ref(key)} AS STRING) AS key")
        for name, (frame, key) in dimensions.items()
    ]
    counted = reduce(DataFrame.unionByName, keys).where("key IS NOT NULL").groupBy("dimension", "key")
    return counted.agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")
