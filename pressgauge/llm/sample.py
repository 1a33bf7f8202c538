"""A bounded sample of labelled documents for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int, where: Column | None = None, id_col: str = "doc_id"
) -> DataFrame:
    """Documents (``text``) with the columns of their labels, for the ``rows`` labels whose id has the least hash.

    The chosen labels are at most ``rows``, so they are broadcast and no text moves. Labels without
    an id are not chosen.
    """
    known = labels.filter(F.col(id_col).isNotNull())
    if where is not None:
        known = known.filter(where)
    chosen = known.orderBy(F.xxhash64(id_col), id_col).limit(rows)
    return docs.select(id_col, "text").join(F.broadcast(chosen), id_col)
