"""Best row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

_RANK = "__rank"


def _quoted(name: str) -> str:
    return f"`{name}`"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the first row of every key under ``order``, a list of SQL sort terms.

    A rank-1 filter directly on ``row_number`` lets Spark cut each key to one row before the shuffle
    as well as after it, so a key that holds a large share of all rows sends one row per task. For a
    repeatable result ``order`` has to be total up to identical rows; see ``breaking_ties``.
    """
    by = ", ".join(map(_quoted, keys))
    # With nothing left to order by, the rows of a key are identical.
    terms = ", ".join(order) or "1"
    rank = f"row_number() OVER (PARTITION BY {by} ORDER BY {terms}) AS {_RANK}"
    return df.selectExpr("*", rank).where(f"{_RANK} = 1").drop(_RANK)


def breaking_ties(df: DataFrame, order: Sequence[str], used: Sequence[str]) -> list[str]:
    """``order`` followed by every column not in ``used``, descending, nulls last."""
    rest = [f"{_quoted(c)} DESC NULLS LAST" for c in df.columns if c not in used]
    return [*order, *rest]
