"""Joins that need more than ``DataFrame.join``.

Inner, semi and anti joins, and outer joins whose preserved side is the long one, are
plain ``join`` calls: adaptive execution splits a hot key there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_all_parents(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """``parent LEFT JOIN child`` for a key that may hold a large share of the child rows.

    A left outer join cannot split a hot key of its right side, an inner join can.
    So the matches come from an inner join, and parents without a child are added;
    the child keys shrink to one row each before that second join.
    """
    matched = parent.join(child, key)
    lonely = parent.join(child.select(key).distinct(), key, "left_anti")
    return matched.unionByName(lonely, allowMissingColumns=True)


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows whose key (NULL too) has no parent."""
    return child.join(parent.select(F.col(parent_key or key).alias(key)).distinct(), key, "left_anti")


def changed_rows(
    source: DataFrame, target: DataFrame, keys: list[str], tracked: list[str], null_safe: bool = True
) -> DataFrame:
    """Source rows whose key is in ``target`` with a different value in a tracked column.

    With ``null_safe=False`` a change from or to NULL is not seen, as with ``!=``.
    """
    old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in tracked])
    return source.join(old, keys).filter(differs(tracked, null_safe)).select(*source.columns)


def differs(tracked: list[str], null_safe: bool = True):
    """Whether any tracked column differs from its ``_old_`` twin; NULL only if not ``null_safe``."""
    result = F.lit(False)
    for c in tracked:
        new, old = F.col(c), F.col(f"_old_{c}")
        result = result | (~new.eqNullSafe(old) if null_safe else new != old)
    return result
