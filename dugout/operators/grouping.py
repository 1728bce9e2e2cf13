"""Grouped sums that also carry text labels, without text in the aggregation buffers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_with_labels(
    df: DataFrame,
    keys: Sequence[str],
    labels: Sequence[str],
    order: str,
    sums: dict[str, Column],
    newest: bool = False,
) -> DataFrame:
    """Sums per key, with each label taken from the row of lowest (or highest) ``order``.

    A text value in a buffer turns a hash aggregate into a sort of all its input. So the
    labels join the keys of a first, numeric aggregation that combines before its shuffle;
    a second one over those few rows picks the labels. Equal orders go to the lesser
    (greater) label.
    """
    if not labels:
        return df.groupBy(*keys).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    end, pick = (F.max, F.max_by) if newest else (F.min, F.min_by)
    parts = df.groupBy(*keys, *labels).agg(
        end(order).alias("_order"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    rank = F.struct("_order", *labels)
    return parts.groupBy(*keys).agg(
        *[pick(c, rank).alias(c) for c in labels], *[F.sum(n).alias(n) for n in sums]
    )
