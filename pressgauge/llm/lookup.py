"""Join with a table of groups whose number is checked before it is broadcast; column names that clash with nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressgauge.operators.skew import counted_join

#: More groups than this are joined by a shuffle with hot groups split.
MAX_BROADCAST_GROUPS = 100_000


def group_join(rows: DataFrame, groups: DataFrame, key: str, count: str) -> DataFrame:
    """Give every row the columns of its group; a null key is a group. ``count`` is the group's number of rows.

    ``groups`` has each key of ``rows`` once, and is read twice, so it should be a written table.
    The join's own copy of the key and ``count`` are dropped.
    """
    if groups.count() <= MAX_BROADCAST_GROUPS:
        named = groups.withColumnRenamed(key, "_key")
        same = rows[key].eqNullSafe(named["_key"])
        return rows.join(F.broadcast(named), same).drop("_key", count)
    return counted_join(rows, groups, key, count).drop(count)


def numbered_columns(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns ``c0``, ``c1``, ... and the new name of each old one, so that no added column clashes."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def named_back(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """The columns that :func:`numbered_columns` renamed, under their old names and in their old order."""
    return rows.select(*[F.col(new).alias(old) for old, new in names.items()])


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, or with the first number behind it that no column of ``docs`` has; letter case does not count."""
    taken = {c.lower() for c in docs.columns}
    numbered = (f"{name}_{i}" for i in range(1, len(taken) + 2))
    return name if name.lower() not in taken else next(n for n in numbered if n.lower() not in taken)
