"""Joins of a large table to a table that is unique on the join key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tasks over which rows with a NULL key are spread: they match nothing.
NULL_SPREAD = 1024


def lookup_join(big: DataFrame, lookup: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join `big` to `lookup` (unique on `on`); adaptive execution picks broadcast and splits hot keys.

    Rows of `big` with a NULL key would all be sent to one task only to find nothing, so they
    get a number as a further key. It follows from the row's own columns and not from its
    place, so a task that runs again sends the row where it went before. Each side is
    read once.
    """
    on = list(on)
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join does not cover how={how!r}")
    nullable = {f.name for f in big.schema.fields if f.nullable}
    holes = [c for c in on if c in nullable]
    if how not in ("left", "left_anti") or not holes:
        return big.join(lookup, on, how)
    empty = F.lit(False)
    for c in holes:
        empty = empty | F.col(f"`{c}`").isNull()
    # Maps have no hash; their columns are left out, as every other column tells rows apart as well.
    own = [F.col(f"`{f.name}`") for f in big.schema.fields if "map<" not in f.dataType.simpleString()]
    spread = F.when(empty, 1 + F.pmod(F.xxhash64(*own), F.lit(NULL_SPREAD))).otherwise(0).cast("int")
    # Zero too, but no literal, which the optimizer would take out of the join key.
    zero = F.pmod(F.hash(*on), F.lit(1)).cast("int")
    out = big.withColumn("_spread", spread).join(lookup.withColumn("_spread", zero), [*on, "_spread"], how)
    return out.drop("_spread")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Fail when `keys` repeat in `df`; a repeated right key would multiply rows."""
    repeated = df.groupBy(*keys).count().where("count > 1").limit(5).collect()
    if repeated:
        shown = [tuple(r[k] for k in keys) for r in repeated]
        raise ValueError(f"{what}: duplicate key(s) {shown}")
    return df
