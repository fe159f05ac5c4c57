"""Join helpers (J1) that stay balanced when one key holds a large share of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_hot_right(left: DataFrame, right: DataFrame, left_key: str,
                        right_key: str) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key`` for a skewed right side.

    Adaptive execution can split a skewed partition only on the side whose
    rows are not null-extended, which for a left outer join is the left
    side.  So the join is written as an inner join (both sides splittable)
    plus the left rows without a partner, found by an anti join against the
    distinct right keys, which are de-duplicated map-side first; a hot key
    then costs one row per partition in that shuffle.
    """
    inner = left.join(right, left[left_key] == right[right_key], "inner")
    keys = right.select(F.col(right_key).alias("__k")).distinct()
    unmatched = left.join(keys, left[left_key] == keys["__k"], "left_anti")
    unmatched = unmatched.select(
        *[F.col(c) for c in left.columns],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in right.schema.fields])
    return inner.unionByName(unmatched)
