"""Left lookup joins that keep rows without a key out of one partition."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPREAD = 256


def left_lookup(rows: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` left join ``lookup`` on ``keys``.  A NULL key matches nothing, so
    such rows get a partition number hashed from the row instead of all
    meeting in the partition of NULL; all other rows have number 0, as the lookup has.

    The keys are compared null-safely (the number alone keeps NULL from matching): for a plain
    equality Spark infers that the lookup's keys are not NULL and pushes that down to the
    scan, with every expression that a key is made of written out once per reference."""
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    spread = F.when(no_key, 1 + F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in plain]), F.lit(SPREAD)).cast("int")).otherwise(0)
    # 0, but computed from the key: a literal would be folded out of the join's keys
    named = {k: f"_lookup{i}" for i, k in enumerate(keys)}
    right = lookup.withColumnsRenamed(named).withColumn("_lookup_spread", F.pmod(F.xxhash64(*named.values()), F.lit(1)).cast("int"))
    left = rows.withColumn("_spread", spread)
    same = [F.col(k).eqNullSafe(F.col(n)) for k, n in named.items()] + [F.col("_spread").eqNullSafe(F.col("_lookup_spread"))]
    out = left.join(right, reduce(lambda a, b: a & b, same), "left").drop("_spread", "_lookup_spread", *named.values())
    return out.select(*keys, *[F.col(f"`{c}`") for c in out.columns if c not in keys])
