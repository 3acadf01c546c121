"""Product identity across systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.operators.relational import one_row_per, union_all

# Id prefixes, confidences and rules of the three product systems.
SYSTEMS = {
    "m5": ("M5_", 1.0, "m5_item_id_direct"),
    "retail_inventory": ("RET_", 0.9, "retail_product_id_direct"),
    "dataco": ("DATACO_", 0.8, "dataco_card_id_direct"),
}

# Which system's mapping wins for an id that several systems know.
SYSTEM_PRIORITY = ("m5", "supplier_internal", "retail_inventory", "dataco")


def build_crosswalk(products: dict[str, DataFrame]) -> DataFrame:
    """Canonical ids from native ids. Each frame has product_id, name, category, department;
    repeated ids collapse to one row in a partial aggregate."""
    parts = []
    for system, df in products.items():
        prefix, confidence, rule = SYSTEMS[system]
        unique = one_row_per(df.filter("product_id IS NOT NULL"), ["product_id"], ["name", "category", "department"])
        parts.append(
            unique.select(
                F.concat(F.lit(prefix), F.col("product_id")).alias("canonical_sku_id"),
                F.lit(system).alias("source_system"),
                F.col("product_id").alias("source_product_id"),
                F.col("name").alias("source_product_name"),
                F.col("category").alias("source_category"),
                F.col("department").alias("source_department"),
                F.lit(confidence).alias("confidence"),
                F.lit(rule).alias("mapping_rule"),
            )
        )
    return union_all(parts)


def repair_crosswalk(crosswalk: DataFrame, sku_ids: list[DataFrame]) -> DataFrame:
    """Add a self mapping for every supplier-side SKU the crosswalk lacks."""
    wanted = union_all([d.select(F.col("sku_id").alias("canonical_sku_id")) for d in sku_ids])
    missing = wanted.filter("canonical_sku_id IS NOT NULL").distinct().join(
        crosswalk.select("canonical_sku_id"), "canonical_sku_id", "left_anti"
    )
    own = missing.select(
        "canonical_sku_id",
        F.lit("supplier_internal").alias("source_system"),
        F.col("canonical_sku_id").alias("source_product_id"),
        F.col("canonical_sku_id").alias("source_product_name"),
        F.lit("supplier_internal").alias("source_category"),
        F.lit("supplier_internal").alias("source_department"),
        F.lit(1.0).alias("confidence"),
        F.lit("supplier_sku_self_mapping").alias("mapping_rule"),
    )
    return crosswalk.select(own.columns).unionByName(own)


def system_rank(system="source_system"):
    return F.array_position(F.array(*[F.lit(s) for s in SYSTEM_PRIORITY]), F.col(system))


def preferred_ids(crosswalk: DataFrame) -> DataFrame:
    """One canonical id per native id: the system with the best priority, then the smallest id."""
    ranked = crosswalk.filter(system_rank() > 0)
    return ranked.groupBy(F.col("source_product_id").alias("sku_id")).agg(
        F.min(F.struct(system_rank().alias("r"), F.col("canonical_sku_id").alias("id"))).getField("id").alias("canonical_sku_id")
    )


def resolve_sku(mapping: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Canonical id of each mapped SKU; an unknown id stands for itself."""
    return (
        mapping.join(preferred_ids(crosswalk), "sku_id", "left")
        .withColumn("canonical_sku_id", F.coalesce("canonical_sku_id", "sku_id"))
    )


def dim_skus(crosswalk: DataFrame) -> DataFrame:
    """One row per canonical id with each system's id as a column.

    One conditional aggregate replaces a join per system, so two ids of one system in the same
    canonical id cannot multiply rows. Category and department come from the preferred system.
    """
    def per_system(system: str):
        return F.max(F.when(F.col("source_system") == system, F.col("source_product_id")))

    best = F.min(
        F.struct(
            F.when(system_rank() > 0, system_rank()).otherwise(99).alias("r"),
            F.col("source_product_id").alias("p"),
            F.col("source_category").alias("category"),
            F.col("source_department").alias("department"),
            F.col("source_product_name").alias("name"),
        )
    )
    return (
        crosswalk.groupBy("canonical_sku_id")
        .agg(
            per_system("m5").alias("m5_item_id"),
            per_system("retail_inventory").alias("retail_product_id"),
            per_system("dataco").alias("dataco_product_id"),
            best.alias("b"),
            F.max("confidence").alias("confidence"),
            F.countDistinct("source_system").alias("system_count"),
        )
        .select(
            "canonical_sku_id",
            "m5_item_id",
            "retail_product_id",
            "dataco_product_id",
            F.col("b.name").alias("product_name"),
            F.col("b.category").alias("category"),
            F.col("b.department").alias("department"),
            "confidence",
            "system_count",
        )
    )


def pick_by_priority(crosswalk: DataFrame) -> DataFrame:
    """Preferred system and category per canonical id, by the fixed system order."""
    best = F.min(F.struct(system_rank().alias("r"), F.col("source_product_id"), F.col("source_system"), F.col("source_category")))
    return (
        crosswalk.filter(system_rank() > 0)
        .groupBy("canonical_sku_id")
        .agg(best.alias("b"))
        .select("canonical_sku_id", "b.source_system", "b.source_product_id", "b.source_category")
    )
