"""Product dimension operators: bridge, active hierarchy, paths, path parsing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecheck.functions.paths import LEVELS, cumulative_paths, path_parts


def product_bridge(product: DataFrame, hierarchy: DataFrame, level: int = 7) -> DataFrame:
    """Active products with their active hierarchy code at one level, distinct.

    Output: l0_name..l5_name, product_code (the SKU), product_id, hierarchy_code.
    """
    pm = product.alias("pm")
    ph = hierarchy.alias("ph")
    return (pm.join(ph, (F.col("pm.l0_name") == F.col("ph.l0_name"))
                    & (F.col("pm.sku") == F.col("ph.sku")))
            .where((F.col("ph.level") == level) & F.col("ph.active") & F.col("pm.active"))
            .select(*[F.col(f"pm.{c}") for c in LEVELS],
                    F.col("pm.sku").alias("product_code"), F.col("pm.product_id"),
                    F.col("ph.hierarchy_code"))
            .distinct())


def active_hierarchy(hierarchy: DataFrame, product: DataFrame, level: int = 7) -> DataFrame:
    """Hierarchy rows at ``level`` whose own row and product are active.

    Not de-duplicated: a product listed twice repeats its hierarchy rows,
    as the joins that consume this frame expect.
    """
    prod = product.where(F.col("active")).select("l0_name", "sku")
    return (hierarchy.where(F.col("active") & (F.col("level") == level))
            .join(prod, ["l0_name", "sku"])
            .select(*hierarchy.columns))


def hierarchy_paths(df: DataFrame, channel: str = "channel",
                    leaf: str = "product_code") -> DataFrame:
    """Replace l0_name..l5_name and the leaf by cumulative ``channel-...`` paths.

    Done in ONE select: every path is built from the original level names,
    never from a path built a step earlier.
    """
    paths = cumulative_paths(channel, list(LEVELS), leaf)
    names = list(LEVELS) + [leaf]
    rest = [c for c in df.columns if c not in names]
    return df.select(*[p.alias(n) for p, n in zip(paths, names)], *rest)


def product_code_parts(df: DataFrame, channel: str | None = None,
                       path: str = "product_code") -> DataFrame:
    """Brand, channel and SKU parsed from a product path, optionally one channel.

    Output: l0_name, sku, channel.
    """
    brand, chan, sku = path_parts(path)
    out = df.select(brand.alias("l0_name"), sku.alias("sku"), chan.alias("channel"))
    if channel is not None:
        out = out.where(F.col("channel") == channel)
    return out
