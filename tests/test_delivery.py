import json
import random
import re
from html.parser import HTMLParser
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
from conftest import vector_frame
from pyspark.sql import functions as F

from nearfield.functions.names import base_name, shard_number
from nearfield.operators.cursor import Cursor, index_pages, page_count, scan_page_at, store_pages
from nearfield.operators.ordinals import with_chunk, with_ordinal, with_page
from nearfield.operators.paging import first_rows, scan_pages, search_pages
from nearfield.sources.html import anchor_targets
from nearfield.sources.json_chunks import export_json_chunks
from nearfield.sources.links import extract_links, link_manifest, shard_paths, write_links
from nearfield.sources.tables import write_clustered
from nearfield.sources.vecfiles import current_folder


def test_ordinals_partition_the_input(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 k").repartition(6)
    rows = with_ordinal(df, [F.col("k").desc(), "id"]).orderBy("ordinal").collect()
    assert [r.ordinal for r in rows] == list(range(1000))
    assert [(r.k, r.id) for r in rows] == sorted(((i % 3, i) for i in range(1000)), key=lambda t: (-t[0], t[1]))


def test_ordinals_by_group_with_a_hot_group(spark):
    df = spark.range(900).selectExpr("id", "if(id < 800, 'hot', if(id < 850, 'b', null)) g")
    rows = with_ordinal(df, ["id"], by=["g"]).collect()
    for g in ("hot", "b", None):
        assert sorted(r.ordinal for r in rows if r.g == g) == list(range(sum(r.g == g for r in rows)))


def test_weighted_ordinals(spark):
    df = spark.createDataFrame([(i, i % 4 + 1) for i in range(50)], "v long, w long").repartition(4)
    rows = with_ordinal(df, ["v"], weight="w").orderBy("v").collect()
    assert [r.ordinal for r in rows] == np.cumsum([0] + [r.w for r in rows])[:-1].tolist()


def test_ordinals_of_nothing(spark):
    assert with_ordinal(spark.range(5).where("id > 9"), ["id"]).count() == 0


def test_chunks_cross_files(spark):
    rows = [(g, s, i) for g, sizes in {0: [3, 0, 5], 1: [2]}.items() for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "grp long, shard_no long, row_index long")
    placed = with_chunk(df, 4, ["grp"], shard="shard_no", row="row_index")
    found = [tuple(r) for r in placed.select("grp", "ord", "chunk").orderBy("grp", "ord").collect()]
    assert found == [(0, i, i // 4) for i in range(8)] + [(1, 0, 0), (1, 1, 0)]
    by_order = with_chunk(df, 4, ["grp"], order=["shard_no", "row_index"])
    assert set(by_order.collect()) == set(placed.collect())


def test_pages(spark):
    df = spark.range(95).selectExpr("id pk")
    assert {r.page: r["count"] for r in with_page(df, ["pk"], 10).groupBy("page").count().collect()} == {
        **{p: 10 for p in range(9)}, 9: 5,
    }
    paged = scan_pages(df, "pk >= 5", 20, limit=50, verify=True)
    assert sorted(r.pk for r in paged.collect()) == list(range(5, 55))
    with pytest.raises(ValueError, match="90 rows, expected 91"):
        scan_pages(df, "pk >= 5", 20, limit=91, verify=True)


@pytest.mark.parametrize("metric", ["cosine", "l2", "cosine_distance"])
def test_search_pages(spark, rng, metric):
    base, q = rng.normal(size=(120, 5)).astype(np.float32), rng.normal(size=5).astype(np.float32)
    base[40] = base[3]
    x, y = base.astype(float), q.astype(float)
    if metric == "l2":
        d = ((x - y) ** 2).sum(axis=1)
    else:
        d = x @ y / np.linalg.norm(x, axis=1) / np.linalg.norm(y)
        d = -d if metric == "cosine" else 1 - d
    order = sorted(range(120), key=lambda i: (round(d[i], 12), i))
    pages = search_pages(vector_frame(spark, range(120), base), q.tolist(), metric, batch=25, limit=100, verify=True)
    rows = pages.orderBy("rank").collect()
    assert [r.id for r in rows] == order[:100]
    assert [r.page for r in rows] == [i // 25 for i in range(100)]


def test_json_documents(spark, tmp_path):
    rows = [(g, s, i, g * 100 + s * 10 + i) for g in (0, 1) for s in (0, 1) for i in range(5 - g)]
    df = spark.createDataFrame(rows, "grp long, shard_no long, row_index long, pk long").withColumn(
        "float32_vector", F.array(F.lit(1e-5).cast("float"), (F.col("pk") / 3).cast("float"))
    )
    export_json_chunks(df, str(tmp_path / "out"), 4, shard="shard_no", row="row_index")
    found = {}
    folder = Path(current_folder(str(tmp_path / "out")))
    assert sorted(p.name for p in folder.iterdir()) == ["grp=0", "grp=1"]  # a folder per group, a file per chunk
    assert sum(p.is_file() for p in folder.rglob("*")) == 5
    for file in folder.rglob("chunk-*"):
        key = tuple(int(x) for x in re.search(r"grp=(\d+)/chunk-(\d+).json", str(file)).groups())
        assert key not in found  # one document per chunk
        text = file.read_text()
        assert text.startswith('{"rows":[{"pk":') and text.endswith("]}\n")
        found[key] = json.loads(text)["rows"]
    assert {k: len(v) for k, v in found.items()} == {
        (0, 0): 4, (0, 1): 4, (0, 2): 2, (1, 0): 4, (1, 1): 4,
    }
    assert [r["pk"] for k in sorted(found) if k[0] == 0 for r in found[k]] == [r[3] for r in rows if r[0] == 0]
    first = found[0, 0][1]
    assert first["float32_vector"] == [1e-05, round(float(np.float32(1 / 3)), 8)]


def test_shard_paths(spark):
    one = [r.path for r in shard_paths(spark, "v_%05d.parquet", 98, 101).orderBy("i").collect()]
    assert one == ["v_00098.parquet", "v_00099.parquet", "v_00100.parquet"]
    two = [r.path for r in shard_paths(spark, "p_%02d-%d.parquet", 8, 10, 2).orderBy("i", "j").collect()]
    assert two == ["p_08-0.parquet", "p_08-1.parquet", "p_09-0.parquet", "p_09-1.parquet"]


def test_links(spark, tmp_path):
    urls = link_manifest(
        spark.range(3), "https://h.example.org/a%20b/", {"m": "m_%04d.parquet", "v": "v_%04d.npy"}, "id"
    )
    dest = str(tmp_path / "links")
    write_links(urls, dest)
    write_links(urls, dest)
    lines = sorted(r.value for r in spark.read.text(dest).collect())
    assert len(lines) == 6 and lines[0] == "https://h.example.org/a%20b/m_0000.parquet"
    write_links(urls, dest, mode="append")
    assert spark.read.text(dest).count() == 12


def test_extract_links(spark):
    html = (
        '<a href="part_emb_0000.npy">x</a><A class="b" HREF=\'part_emb_0001.npy\'>y</A>'
        '<a href="other.txt">z</a>\n<a\nhref="part_emb_2.npy?a=1&amp;b=2">w</a><abbr href="part_emb_9">'
        """<a data-href="part_emb_x" href="part_emb_it's">v</a><a href=part_emb_3>u</a>"""
    )
    pages = spark.createDataFrame([(1, html), (2, "nothing"), (3, None)], "page_id long, html string")
    found = extract_links(pages, "part_emb").orderBy("page_id", "pos").collect()
    assert [r.href for r in found] == ["part_emb_0000.npy", "part_emb_0001.npy", "part_emb_2.npy?a=1&b=2", "part_emb_it's", "part_emb_3"]
    assert [r.pos for r in found] == sorted(r.pos for r in found)


def test_names(spark):
    df = spark.createDataFrame(
        [("/a/b/part_emb_0042.npy",), ("x_7.parquet",), ("none.txt",), ("v2/plain",)], "p string"
    )
    assert [tuple(r) for r in df.select(base_name("p"), shard_number("p")).collect()] == [
        ("part_emb_0042.npy", 42), ("x_7.parquet", 7), ("none.txt", None), ("plain", None),
    ]


def test_a_limit_bounds_what_is_sorted(spark):
    rows = spark.range(20_000).selectExpr("id * 7919 % 20011 pk")
    kept = first_rows(rows, F.col("pk"), 50)
    assert 50 <= kept.count() < 500
    expected = sorted(r.pk for r in rows.collect())[:50]
    assert [r.pk for r in scan_pages(rows, None, 10, limit=50).orderBy("ordinal").collect()] == expected
    ties = spark.range(5_000).selectExpr("0 pk")
    assert scan_pages(ties, None, 10, limit=50, verify=True).count() == 50


@pytest.mark.parametrize("limit", [None, 95])
def test_pages_by_cursor(spark, tmp_path, limit):
    """A page is read by its key range from its files; tokens lead through the whole scan in any session."""
    rows = spark.range(1000).selectExpr("id * 7 pk", "id % 10 grp", "cast(id as string) name", "0 page")
    rows.repartitionByRange(6, "pk").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    expected = scan_pages(table.drop("page"), "grp < 4", 30, limit=limit).orderBy("ordinal").collect()
    cursor, found = index_pages(table, str(tmp_path / "i"), 30, expr="grp < 4", limit=limit), []
    assert page_count(spark, cursor.index) == -(-len(expected) // 30)
    while cursor is not None:
        page, after = scan_page_at(spark, Cursor.of(cursor.token()), ["pk", "grp", "name"])
        own = page.orderBy("ordinal").collect()
        assert 0 < len(own) <= 30 and {r.page for r in own} == {cursor.page}
        found, cursor = found + own, after
    assert [(r.pk, r.grp, r.name, r.ordinal, r.page) for r in found] == [(r.pk, r.grp, r.name, r.ordinal, r.page) for r in expected]
    page, _ = scan_page_at(spark, Cursor(str(tmp_path / "i"), 2))
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(pk" in plan and "LessThanOrEqual(pk" in plan
    assert len(page.inputFiles()) < 6
    assert scan_page_at(spark, Cursor(str(tmp_path / "i"), 99))[0].count() == 0


def test_keys_over_the_end_of_a_page(spark, tmp_path):
    spark.range(100).selectExpr("id DIV 3 pk").write.parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError, match="both sides of the end of page 0"):
        index_pages(table, str(tmp_path / "i"), 10)
    assert page_count(spark, index_pages(table, str(tmp_path / "j"), 12).index) == 9  # repeats inside a page do no harm


def test_pages_of_a_stored_search(spark, tmp_path, rng):
    base, q = rng.normal(size=(120, 5)).astype(np.float32), rng.normal(size=5).astype(np.float32)
    pages = search_pages(vector_frame(spark, range(120), base), q.tolist(), "l2", batch=25)
    cursor = store_pages(pages, str(tmp_path / "s"), 25)
    page, after = scan_page_at(spark, Cursor(cursor.index, 3))
    found = [(r["rank"], r.id, r.page) for r in page.orderBy("rank").collect()]
    assert found == [(r["rank"], r.id, r.page) for r in pages.where("page = 3").orderBy("rank").collect()]
    assert after.page == 4 and scan_page_at(spark, after)[1] is None


def test_verifying_starts_no_job(spark, tmp_path):
    """The rows are counted by the job that sorts them."""
    rows = spark.range(500).selectExpr("id pk")
    jobs = []
    for n, verify in enumerate((False, True)):
        spark.sparkContext.setJobGroup(f"verify-{n}", "")
        scan_pages(rows, None, 10, limit=400, verify=verify)
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"verify-{n}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0
    with pytest.raises(ValueError, match="500 rows, expected 501"):
        scan_pages(rows, None, 10, limit=501, verify=True)


class Anchors(HTMLParser):
    """A plain parser of the standard library, to compare with."""

    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        names = [n for n, _ in attrs]
        if tag == "a" and "href" in names:
            self.found.append(attrs[names.index("href")][1] or "")


def test_anchor_tokens_against_a_parser():
    r = random.Random(7)
    parts = [
        '<a href="/x">', "<A HREF='/y z'>", "<a href=/u/v>", '<a class="k" href="/&eacute;&#233;&#xE9;&amp;b=1&lt;">', "</a>", "text ",
        "<!-- <a href='/no'> -->", "<!---->", "<script>var a = '<a href=\"/s\">';</script>", "<style>a{}</style><p>", "<br/>",
        '<img alt="<a href=/in>" src=1>', "<abbr href=/abbr>", '<a name="n">', '<a href="/1" href="/2">', "<a\nhref = '/w'\n>", "a < b > c ",
        "<a data-href=/d href=/e/>", "<p title=it's>", "<!DOCTYPE html>", "&lt;a href=/esc&gt;", '<a href="">', "<a href>", "<a/href=/slash>",
        "<SCRIPT type=x><!-- </a> <a href=/t> --></SCRIPT>", "<?xml <a ?>",
    ]
    for _ in range(3000):
        html = "".join(r.choice(parts) for _ in range(r.randrange(12)))
        parser = Anchors()
        parser.feed(html)
        parser.close()
        assert list(anchor_targets(html)) == parser.found, html
    assert list(anchor_targets('<a href="?a=1&copy=2&copy;&copy&notit;&#65 &amp">')) == ["?a=1&copy=2©©&notit;A &"]
    assert list(anchor_targets("<!-- <a href=x>")) == [] and list(anchor_targets("<a href='x")) == []
    assert list(anchor_targets("<!--> <a href=x>")) == ["x"] and list(anchor_targets("<title><a href=x></title>")) == []


def test_fewer_row_groups_under_a_filter(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id pk", "cast(pmod(xxhash64(id), 40) * 5 as int) label", "id % 7 other")
    rows.repartition(4).write.option("parquet.block.row.count.limit", 1000).parquet(str(tmp_path / "plain"))
    write_clustered(rows, str(tmp_path / "clustered"), ["label"], rows_per_file=5000, rows_per_group=1000)

    def groups(name, label):
        hit = total = 0
        for path in (tmp_path / name).glob("*.parquet"):
            meta = pq.ParquetFile(path).metadata
            at = meta.schema.names.index("label")
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                total += 1
                hit += stats.min <= label <= stats.max
        return hit, total

    plain, clustered = groups("plain", 60), groups("clustered", 60)
    assert plain[0] == plain[1] >= 20 and clustered[0] <= 2 and clustered[1] >= 20
    table = spark.read.parquet(str(tmp_path / "clustered"))
    assert table.where("label = 60").count() == rows.where("label = 60").count() and table.count() == 20_000
    # Values between a row group's ends that it does not hold are ruled out by its Bloom filter.
    raw = b"".join(p.read_bytes() for p in (tmp_path / "clustered").glob("*.parquet"))
    assert len(raw) > sum(c.total_compressed_size for p in (tmp_path / "clustered").glob("*.parquet") for m in [pq.ParquetFile(p).metadata]
                          for g in range(m.num_row_groups) for c in [m.row_group(g).column(i) for i in range(m.num_columns)])
