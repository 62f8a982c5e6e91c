"""Shard names, link lists and links found in listing pages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.sources.html import anchor_targets

PAGES_AT_ONCE = 256


def shard_names(numbers: DataFrame, template: str, columns: list[str], name: str = "shard") -> DataFrame:
    """Format number columns into names, e.g. ``'part_%05d.parquet'``."""
    return numbers.withColumn(name, F.format_string(template, *columns))


def shard_paths(
    spark: SparkSession, template: str, start: int, end: int, inner: int | None = None
) -> DataFrame:
    """Names for start <= i < end, and for 0 <= j < inner inside each i if given."""
    numbers = spark.range(start, end).withColumnRenamed("id", "i")
    columns = ["i"]
    if inner is not None:
        inside = F.filter(F.sequence(F.lit(0), F.lit(inner)), lambda j: j < inner)
        numbers = numbers.select("i", F.explode(inside.cast("array<long>")).alias("j"))
        columns.append("j")
    return shard_names(numbers, template, columns, "path")


def link_manifest(numbers: DataFrame, base_url: str, templates: dict[str, str], number: str = "i") -> DataFrame:
    """One URL per number and kind of file, from ``{kind: template}``."""
    kinds = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.format_string(base_url.replace("%", "%%") + template, F.col(number)).alias("url"),
            )
            for kind, template in templates.items()
        ]
    )
    return numbers.select(number, F.inline(kinds))


def write_links(df: DataFrame, dest: str, mode: str = "overwrite", col: str = "url") -> None:
    """One URL per line. Appending again repeats the lines."""
    df.select(col).write.mode(mode).text(dest)


def extract_links(
    pages: DataFrame, prefix: str = "", page: str = "page_id", html: str = "html"
) -> DataFrame:
    """``(page, pos, href)``: anchor targets that start with ``prefix``; ``pos`` counts a page's anchors in document order.

    Comments, scripts and other raw text hold no anchors; character references are decoded. Null pages have none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(at, PAGES_AT_ONCE)
                found = [
                    (i, pos, href)
                    for i, text in enumerate(part.column(1).to_pylist())
                    for pos, href in enumerate(anchor_targets(text or ""))
                    if href.startswith(prefix)
                ]
                rows = pa.array([f[0] for f in found], pa.int64())
                columns = [part.column(0).take(rows), pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["page", "pos", "href"])

    kind = pages.schema[page].dataType.simpleString()
    picked = pages.select(F.col(page).alias("page"), F.col(html).alias("html"))
    return picked.mapInArrow(run, f"page {kind}, pos int, href string").withColumnRenamed("page", page)
