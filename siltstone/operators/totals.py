"""Totals over several groupings at once, told apart from null keys."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_sets(by: Sequence[str]) -> list[list[str]]:
    return [list(by[:k]) for k in range(len(by), -1, -1)]


def cube_sets(by: Sequence[str]) -> list[list[str]]:
    return [list(c) for k in range(len(by), -1, -1) for c in combinations(by, k)]


def grouping_totals(rows: DataFrame, by: Sequence[str], sets: Sequence[Sequence[str]], **sums: Column) -> DataFrame:
    """Counts and sums for every grouping set: ``by``, grouping_id, n, and the sums.

    grouping_id has a bit for each of ``by`` (the first is the highest), set
    where the column isn't part of the set, so that a null key differs from a
    total. Sums of nothing but nulls are 0; no rows give no totals. Rows are added up by all keys first, so that only
    groups, not rows, are multiplied by the number of sets.
    """
    unknown = {c for s in sets for c in s} - set(by)
    if unknown:
        raise ValueError(f"not among the columns to group by: {sorted(unknown)}")
    base = rows.groupBy(*by).agg(F.count("*").alias("n"), *(F.coalesce(F.sum(c), F.lit(0)).alias(s) for s, c in sums.items()))
    out = base.groupingSets([[F.col(c) for c in s] for s in sets], *by)
    return out.agg(F.grouping_id(*by).cast("long").alias("grouping_id"), F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in sums))


def category_totals(manifest: DataFrame, sets: Sequence[Sequence[str]], by: Sequence[str] = ("category", "site", "kind")) -> DataFrame:
    """Datasets and bytes of a manifest (with a column category) by grouping set."""
    return grouping_totals(manifest, by, sets, total_bytes=F.greatest("size", F.lit(0)))
