"""Dimension logic: latest versions, warehouse hierarchy, item variants, star joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions import scalar as X
from tally.operators.clean import first_per_key

WAREHOUSE_TYPES = ("Main", "Sector", "Transit")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The newest row per key; ``order`` must end in a unique tie-break."""
    return first_per_key(df, keys, order)


def latest_value(df: DataFrame, keys: Sequence[str], value: str, newest: str, tie: str | None = None) -> DataFrame:
    """W1 as an aggregate: per key, ``value`` of the row with the newest ``newest`` (nulls last),
    ties to the smallest ``tie``. Partial aggregation keeps one row per key per map task, so a key
    holding a third of all rows costs no more than any other (a sort-based window would send all
    its rows to one task)."""
    order = F.struct(
        F.col(newest).isNull().alias("_null"),
        (-F.unix_micros(F.col(newest).cast("timestamp"))).alias("_age"),
        F.col(tie or value).alias("_tie"),
    )
    return df.groupBy(*keys).agg(F.min_by(F.col(value), order).alias(value))


def planning_links(
    items: DataFrame,
    linkage: str,
    code: str,
    expiry: str,
    as_of: Column,
    item_type: str,
    branded_type: str,
    brand: str,
    modified: str,
) -> DataFrame:
    """One planning row per ``coalesce(linkage, code)`` (empty counts as null): unexpired items only (no expiry, or
    one on or after ``as_of``), the newest ``modified`` first and ties to the smallest code; ``brand`` is kept only
    for items of ``branded_type``. Output ``planning_key, item_code, item_type, brand``."""
    key = F.coalesce(F.nullif(F.col(linkage), F.lit("")), F.col(code))
    live = items.filter(F.col(expiry).isNull() | (F.col(expiry) >= as_of)).withColumn("planning_key", key)
    newest = first_per_key(live, ["planning_key"], [F.col(modified).desc_nulls_last(), F.col(code)])
    return newest.select(
        "planning_key",
        F.col(code).alias("item_code"),
        F.col(item_type).alias("item_type"),
        F.when(F.col(item_type) == branded_type, F.col(brand)).alias("brand"),
    )


def warehouses_with_profile(warehouses: DataFrame, profiles: DataFrame, exclude: Sequence[str] = ()) -> DataFrame:
    """B6 first half: active, named warehouses of the three types with the replenishment centre that serves them.

    A sector warehouse is served as its physical warehouse is (J8), every other one under its own name, so one lookup by
    that name finds the centre (``No-RC`` without one). ``is_crc`` tells whether a warehouse is some warehouse's
    centre (J7). ``exclude``: LIKE patterns of names to leave out, whatever their case (Q7)."""
    centre_of = latest_value(profiles.filter(F.col("active") == 1), ["warehouse"], "replenishment_center", "modified")
    lookup = centre_of.select(F.col("warehouse").alias("_served_as"), F.col("replenishment_center").alias("_centre"))
    centres = centre_of.select(F.col("replenishment_center").alias("_serves")).distinct()
    wanted = warehouses.filter((F.col("active") == 1) & F.col("warehouse_type").isin(*WAREHOUSE_TYPES) & ~F.coalesce("global_id", F.lit("")).isin("", "NULL"))
    if exclude:
        wanted = wanted.filter(X.exclude_names("name", exclude))
    served_as = F.when(F.col("warehouse_type") == "Sector", F.col("physical_warehouse")).otherwise(F.col("name"))
    found = wanted.withColumn("_served_as", served_as).join(lookup, "_served_as", "left").join(centres, F.col("name") == F.col("_serves"), "left")
    return found.withColumns(
        {"replenishment_center": F.coalesce("_centre", F.lit("No-RC")), "is_crc": F.col("_serves").isNotNull().cast("int")}
    ).drop("_served_as", "_centre", "_serves")


def warehouse_hierarchy(
    warehouses: DataFrame,
    profiles: DataFrame,
    closure: DataFrame,
    include: str | None = None,
    exclude: Sequence[str] = (),
    main_exclude: Sequence[str] = (),
) -> DataFrame:
    """Warehouses with their replenishment centre, deduplicated, under their ancestors.

    ``warehouses``: name, city, state, global_id, warehouse_type, physical_warehouse, active,
    disabled, inactive, modified. ``profiles``: warehouse, replenishment_center, active, modified.
    ``closure``: ref_parent, ref_docname, ref_doctype (already materialised: no recursion).
    Main warehouses are kept latest per (city, global_id, centre) and placed under every ancestor.
    ``exclude`` / ``main_exclude``: LIKE patterns of names left out everywhere / among the main ones.
    """
    wh = warehouses_with_profile(warehouses, profiles, exclude)
    mains = wh.filter((F.col("disabled") == 0) & (F.col("inactive") == 0) & (F.lower("warehouse_type") == "main"))
    if main_exclude:
        mains = mains.filter(X.exclude_names("name", main_exclude))
    if include:
        mains = mains.filter(F.col("name").like(include))
    latest = latest_per_key(
        mains, ["city", "global_id", "replenishment_center"], [F.col("modified").desc(), F.col("name")]
    ).select("global_id", "replenishment_center", "city", "state", F.col("name").alias("warehouse"), "modified")
    edges = closure.filter(F.col("ref_doctype") == "Warehouse").select(
        F.col("ref_parent").alias("higher_hier_warehouse"), F.col("ref_docname").alias("warehouse")
    )
    return edges.join(latest, "warehouse", "inner").select("higher_hier_warehouse", *latest.columns)


def star_join(fact: DataFrame, lookups: Sequence[tuple[DataFrame, str, str]], how: str = "inner") -> DataFrame:
    """A fact table joined to its dimensions one after the other; each entry is
    ``(dimension, column of the fact so far, key of the dimension)``. Keys have different names on both sides. Spark
    broadcasts the dimensions whose measured size allows it and prunes what the caller does not select."""
    for dim, fk, key in lookups:
        fact = fact.join(dim, F.col(fk) == F.col(key), how)
    return fact


def sales_margin(amount: Column, valuation: Column, partner: Column, divisor: float) -> Column:
    """Amount less the stock's valuation, which is divided by ``divisor`` where ``partner`` holds."""
    return amount - F.when(partner, valuation / divisor).otherwise(valuation)


def item_variants(items: DataFrame, brands: DataFrame | None = None, exclude_codes: Sequence[str] = ("%_discount%", "%_supersaver%")) -> DataFrame:
    """B10 first half: one row per item linkage with its representative attributes."""
    it = items
    for p in exclude_codes:
        it = it.filter(~F.lower("item_code").like(p))
    if brands is not None:
        it = it.join(brands, "brand", "left")
    else:
        it = it.withColumn("brand_type", F.lit(None).cast("string"))
    return it.groupBy("item_linkage").agg(
        F.max(F.coalesce("item_classification", "item_sub_category")).alias("er_variant"),
        F.avg("shelf_life_in_days").alias("shelf_life_in_days"),
        F.max("brand").alias("brand"),
        F.max(F.coalesce("brand_type", F.lit("NA"))).alias("brand_type"),
        F.max("item_sub_category").alias("item_sub_category"),
    )


def attach_variant(panel: DataFrame, variants: DataFrame, linkage: str = "item_linkage", sub_category: str = "item_sub_category") -> DataFrame:
    """B10 second half: left join the variant by linkage; missing variants fall back to the
    row's own sub-category (P11); rows without sub-category are dropped (P12)."""
    v = variants.select(F.col("item_linkage").alias(linkage), F.col("er_variant").alias("_v"))
    return (
        panel.join(v, linkage, "left")
        .withColumn("er_variant", F.coalesce("_v", F.col(sub_category)))
        .drop("_v")
        .dropna(subset=[sub_category])
    )


def latest_snapshot(snapshots: DataFrame, snapshot_col: str) -> DataFrame:
    """Rows of the newest snapshot only (filter first, then join: the scalar subquery of
    the reference's ON clause becomes a scalar-subquery filter here)."""
    newest = snapshots.agg(F.max(snapshot_col)).scalar()
    return snapshots.filter(F.col(snapshot_col) == newest)
