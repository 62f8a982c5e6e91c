"""Expressions over shard names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(_col(path), "/"), -1)


def shard_number(name: Column | str) -> Column:
    """The number just before the extension: ``part_0042.npy`` gives 42, no number gives NULL."""
    digits = F.regexp_extract(_col(name), r"(\d+)\.\w+$", 1)
    return F.when(digits != "", digits).cast("int")
