"""Paged scans that can be taken up again: a stored page index and a token for the next page.

The index has one row per page: its range of keys and the files its rows lie in. A page is read by that range
alone, from those files alone; nothing before it is read or sorted again.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from nearfield.operators.assembly import filter_vectors
from nearfield.operators.paging import first_rows
from nearfield.operators.ordinals import with_page

FACTS = "key string, batch long, expr string, total long"


@dataclass(frozen=True)
class Cursor:
    """Where a paged scan stands: its index and the next page."""

    index: str
    page: int = 0

    def token(self) -> str:
        return base64.urlsafe_b64encode(json.dumps([self.index, self.page]).encode()).decode()

    @classmethod
    def of(cls, token: str) -> Cursor:
        return cls(*json.loads(base64.urlsafe_b64decode(token)))


def index_pages(
    table: DataFrame, dest: str, batch: int, key: str = "pk", expr: str | None = None, limit: int | None = None
) -> Cursor:
    """Write the page index of a table read from files to ``dest``; returns the cursor of its first page.

    Pages hold ``batch`` rows that match ``expr``, in key order, ``limit`` rows in all. Only keys and file names are
    sorted. A key may repeat inside a page; one on both sides of a page's end is an error, since its range would not tell them apart.
    """
    spark = table.sparkSession
    rows = filter_vectors(table, expr)
    if limit is not None:
        rows = first_rows(rows, F.col(key), limit)
    paged = with_page(rows.select(F.col(key).alias("key"), F.col("_metadata.file_path").alias("file")), ["key", "file"], batch)
    if limit is not None:
        paged = paged.where(F.col("ordinal") < limit)
    pages = paged.groupBy("page").agg(
        F.min("key").alias("first_key"), F.max("key").alias("last_key"), F.count(F.lit(1)).alias("n_rows"),
        F.array_sort(F.collect_set("file")).alias("files"),
    )
    pages.repartitionByRange("page").sortWithinPartitions("page").write.mode("overwrite").parquet(f"{dest}/pages")
    stored = spark.read.parquet(f"{dest}/pages")
    ends = stored.select((F.col("page") + 1).alias("page"), F.col("last_key").alias("before"))
    split = stored.join(ends, "page").where("first_key <= before").orderBy("page").first()
    if split is not None:
        raise ValueError(f"key {split.first_key} lies on both sides of the end of page {split.page - 1}")
    total = stored.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    spark.createDataFrame([(key, batch, expr, total)], FACTS).write.mode("overwrite").json(f"{dest}/facts")
    return Cursor(dest)


def page_count(spark: SparkSession, index: str) -> int:
    facts = spark.read.schema(FACTS).json(f"{index}/facts").first()
    return -(-facts.total // facts.batch)


def scan_page_at(spark: SparkSession, cursor: Cursor, columns: list[str] | None = None) -> tuple[DataFrame, Cursor | None]:
    """The cursor's page with ``ordinal`` and ``page``, and the cursor of the page after it (None behind the last).

    A page behind the last is empty. The table's files must be as they were when the index was written.
    """
    facts = spark.read.schema(FACTS).json(f"{cursor.index}/facts").first()
    page = spark.read.parquet(f"{cursor.index}/pages").where(F.col("page") == cursor.page).first()
    if page is None:
        first = spark.read.parquet(f"{cursor.index}/pages").select("files").first()
        files, wanted = (first.files if first else []), F.lit(False)
        if not files:
            raise ValueError(f"{cursor.index}: the scan has no rows")
    else:
        files, wanted = page.files, F.col(facts.key).between(page.first_key, page.last_key)
    rows = filter_vectors(spark.read.parquet(*files).where(wanted), facts.expr)
    if columns is not None:
        rows = rows.select(*dict.fromkeys([*columns, facts.key]))
    place = F.row_number().over(Window.orderBy(facts.key)) - 1  # a page has at most ``batch`` rows
    rows = rows.withColumns({"ordinal": (F.lit(cursor.page * facts.batch) + place).cast("long"), "page": F.lit(cursor.page).cast("long")})
    after = Cursor(cursor.index, cursor.page + 1) if (cursor.page + 1) * facts.batch < facts.total else None
    return rows, after


def store_pages(paged: DataFrame, dest: str, batch: int, key: str = "rank") -> Cursor:
    """Write a paged result (of a search) in key order and index it, so that its pages can be fetched later."""
    paged.drop("page", "ordinal").repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{dest}/rows")
    return index_pages(paged.sparkSession.read.parquet(f"{dest}/rows"), f"{dest}/index", batch, key)
