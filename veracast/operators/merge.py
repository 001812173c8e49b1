"""Insert-only merge: rows whose key the target does not hold yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from veracast.functions.rules import all_present
from veracast.operators.top_one import breaking_ties, first_per_key


def merge_insert_only(
    source: DataFrame,
    target: DataFrame,
    key: str | Sequence[str],
    first: Sequence[str] = (),
) -> DataFrame:
    """Rows of ``source`` to append to ``target``.

    One row per key, the first under the sort terms ``first`` (remaining columns settle ties); keys
    already in ``target`` are left out. A key with a null part equals nothing, so such rows are all kept. They
    take a branch of their own: ranked or joined, they would meet in a single task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    whole = all_present(*[F.col(k) for k in keys])
    order = breaking_ties(source, list(first), keys)
    candidates = first_per_key(source.where(whole), keys, order)
    # Distinct before the join: repeated keys shrink map-side, and the join reuses the shuffle.
    held = target.where(whole).select(*keys).distinct()
    unkeyed = source.where(~whole)
    return candidates.join(held, keys, "left_anti").select(*source.columns).unionByName(unkeyed)


def only_matching(target: DataFrame, batch: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """The key rows of ``target`` that a batch can meet.

    As a semi join Spark may broadcast the batch's keys when it knows them to be small, which saves
    shuffling the whole target for every micro-batch; beyond its threshold it shuffles both.
    """
    keys = [key] if isinstance(key, str) else list(key)
    return target.select(*keys).join(batch.select(*keys).distinct(), keys, "left_semi")
