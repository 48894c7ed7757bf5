"""Product paths: ``channel-l0-l1-l2-l3-l4-l5-sku`` strings.

Paths of the store channel carry one extra leading segment (``Retail-``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LEVELS = ("l0_name", "l1_name", "l2_name", "l3_name", "l4_name", "l5_name")

# fixed values: prefix that marks store-channel paths and the separator
RETAIL_PREFIX = "Retail"
SEP = "-"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def cumulative_paths(channel: Column | str, levels: list[Column | str],
                     leaf: Column | str) -> list[Column]:
    """One column per level: the path from the channel down to that level,
    then the full path ending in the leaf.

    All outputs are computed from the *input* columns, so they can be used
    in one ``select`` even when they reuse the input names. ``concat`` gives
    NULL when any part is NULL.
    """
    parts = [_col(channel)]
    out = []
    for lvl in levels:
        parts = parts + [F.lit(SEP), _col(lvl)]
        out.append(F.concat(*parts))
    out.append(F.concat(*(parts + [F.lit(SEP), _col(leaf)])))
    return out


def path_parts(path: Column | str) -> tuple[Column, Column, Column]:
    """(brand, channel, sku) of a product path.

    Store paths start with ``Retail`` and have one more leading segment.
    A too-short path raises (ANSI array index); the sku is the last segment.
    """
    p = _col(path)
    pieces = F.split(p, SEP)
    is_retail = p.startswith(RETAIL_PREFIX)
    brand = F.when(is_retail, pieces[2]).otherwise(pieces[1])
    channel = F.when(is_retail, pieces[1]).otherwise(pieces[0])
    sku = F.element_at(pieces, -1)
    return brand, channel, sku


def brand_sku_key(brand: Column | str, sku: Column | str) -> Column:
    """Brand and SKU glued with no separator (NULL if either is NULL)."""
    return F.concat(_col(brand), _col(sku))
