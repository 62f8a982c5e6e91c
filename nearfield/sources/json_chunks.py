"""Export as JSON documents of a fixed number of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nearfield.functions.metrics import round_vector
from nearfield.operators.ordinals import join_sized, with_chunk
from nearfield.sources.vecfiles import write_text_files

CHUNK_ROWS = 40_000  # fixed value: rows per document


def chunk_lines(
    df: DataFrame,
    chunk_size: int = CHUNK_ROWS,
    group: str = "grp",
    order: list[str | Column] | None = None,
    key: str = "pk",
    vector: str = "float32_vector",
    decimals: int = 8,
    shard: str | None = None,
    row: str | None = None,
) -> DataFrame:
    """(``group``, ``chunk``, ``ord``, ``value``): the lines of every document.

    A document is ``{"rows":[`` row ``,`` row … ``]}`` with one row per line, so it can be
    written as text lines and never exists as one string.
    """
    placed = with_chunk(df, chunk_size, [group], order or [key], shard, row)
    sizes = placed.groupBy(group).agg(F.max("ord").alias("_last"))
    placed = join_sized(placed, sizes, [group])
    first = F.col("ord") % chunk_size == 0
    last = (F.col("ord") % chunk_size == chunk_size - 1) | (F.col("ord") == F.col("_last"))
    row = F.to_json(F.struct(F.col(key), round_vector(vector, decimals).alias(vector)))
    return placed.select(
        group,
        "chunk",
        "ord",
        F.concat(
            F.when(first, F.lit('{"rows":[')).otherwise(F.lit("")),
            row,
            F.when(last, F.lit("]}")).otherwise(F.lit(",")),
        ).alias("value"),
    )


def export_json_chunks(
    df: DataFrame,
    dest: str,
    chunk_size: int = CHUNK_ROWS,
    group: str = "grp",
    order: list[str | Column] | None = None,
    key: str = "pk",
    vector: str = "float32_vector",
    decimals: int = 8,
    shard: str | None = None,
    row: str | None = None,
) -> None:
    """Write one file per (``group``, ``chunk``): ``<group>=<value>/chunk-<number>.json`` in the committed version of ``dest``.

    A group has one folder, whatever its number of chunks; ``current_folder(dest)`` is where they lie.
    """
    lines = chunk_lines(df, chunk_size, group, order, key, vector, decimals, shard, row)
    file = F.concat(F.lit(f"{group}="), F.col(group).cast("string"), F.format_string("/chunk-%06d.json", "chunk"))
    write_text_files(lines, file, ["ord"], dest)
