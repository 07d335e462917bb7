"""Keep one row per key, always the same one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The smallest row of each key, NULLs first, by ``order`` and then every other column.

    A minimum over a struct combines on the map side, so a key that holds a large share of
    the rows reaches the shuffle as one row per input task. NULL keys form one group.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = [*order, *rest]
    if not ranked:
        return df.select(*keys).distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("_first"))
    return first.select(*[F.col(c) if c in keys else F.col(f"_first.{c}").alias(c) for c in df.columns])
