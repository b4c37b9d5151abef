"""Keyed write rules as DataFrame algebra (no table format needed).

The result is a new table version; callers write it to a new directory and
never overwrite a path that is being read (see ``clicklens.sinks``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert_replace(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key; other old
    rows stay."""
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new)


def upsert_add(old: DataFrame, new: DataFrame, keys: list[str], measure: str) -> DataFrame:
    """Measures of equal keys are added; new keys are inserted."""
    return old.unionByName(new).groupBy(*keys).agg(F.sum(measure).cast("bigint").alias(measure))


def replace_groups(old: DataFrame, new: DataFrame, group_keys: list[str]) -> DataFrame:
    """Delete every old row whose group (``group_keys``) occurs in ``new``,
    then insert all of ``new`` (a group is replaced wholly)."""
    groups = new.select(*group_keys).distinct()
    return old.join(groups, group_keys, "left_anti").unionByName(new)


def append_new(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Append the rows of ``new`` whose key is not in ``old`` yet (each once)."""
    fresh = new.select(*keys).distinct().join(old.select(*keys), keys, "left_anti")
    return old.select(*keys).unionByName(fresh)
