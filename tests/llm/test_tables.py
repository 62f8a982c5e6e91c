"""Mixing, vectors, archives and the pipeline."""

from __future__ import annotations

import gzip
import hashlib
import io
import math
import zipfile
from collections import Counter, defaultdict

import numpy as np
import pytest
from odd_rows import documents, empty  # noqa: F401  (fixtures)
from pyspark.sql import functions as F

import corpus_pipeline
from nearfield.llm import capfilters, warc, zipranges
from nearfield.llm.capfilters import choose_code, vector_links
from nearfield.llm.files import Ranges
from nearfield.llm.mixing import _hypergeometric, mix_sources, mixing_plan, shard_quotas


# --- op 4 ---------------------------------------------------------------------------------

@pytest.fixture
def pages(spark):
    body = "<p>" + "é" * 60 + "</p>"
    rows = [
        (3, "http://a/ b\r\n", body, 1), (1, "http://b", body, 2), (2, None, body + "!", 3), (4, "u", "small", 4),
        (5, "u", "small", 5), (6, "u", None, 6), (7, "u", "", 7), (None, "u", body, 8), (8, "u", "a\r\n\r\nb" * 40, 9),
        (9, "u", "WARC/1.1\r\n\r\n" * 9, 10), (1, "http://b", body, 2),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, payload long").repartition(3)


def test_archives(pages, tmp_path):
    packages = warc.write_packages(pages, f"file://{tmp_path}/w", package_bytes=300)
    assert packages.count() >= 3
    found = warc.read_packages(packages, with_payload=True).collect()
    data = [(r.page_id, (r.html or "").encode()) for r in pages.collect()]
    first = defaultdict(list)
    for k, body in data:
        if k is not None:
            first[body].append(k)
    expected = Counter()
    for k, body in data:
        again = len(body) >= 100 and k != min(first[body])
        expected[k, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response",
                 min(first[body]) if again else None, None if again else body] += 1
    assert Counter(
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, None if r.payload is None else bytes(r.payload))
        for r in found
    ) == expected
    none = warc.write_packages(pages.limit(0), f"file://{tmp_path}/none")
    assert warc.read_packages(none).count() == 0
    with zipfile.ZipFile(packages.first().path.removeprefix("file://")) as z:  # others can read it too
        assert z.testzip() is None and gzip.decompress(z.read(warc.DATA)).startswith(b"WARC/1.1")


def test_zip64_and_comments(tmp_path, monkeypatch):
    path = tmp_path / "x.zip"
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 50)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for i in range(40):
            z.writestr(f"m{i}", bytes([i]) * 70)
        z.writestr("packed", b"a" * 90, zipfile.ZIP_DEFLATED)
        z.comment = b"PK\x05\x06 looks like an end"
    with Ranges(f"file://{path}") as file:
        found = {m.name: m for m in zipranges.members(file)}
        assert len(found) == 41
        assert all(file.read(found[f"m{i}"].start(file), 70) == bytes([i]) * 70 for i in range(40))
        with pytest.raises(ValueError, match="compressed"):
            found["packed"].start(file)
    path.write_bytes(b"no zip at all")
    with Ranges(f"file://{path}") as file, pytest.raises(ValueError, match="not a ZIP"):
        list(zipranges.members(file))


# --- op 7 ---------------------------------------------------------------------------------

def test_mix(documents, empty):
    plan = mixing_plan(documents, block_words=100, shard_words=500)
    rows = plan.collect()
    assert plan.columns[: len(documents.columns)] == documents.columns
    size, target, taken = Counter(), {}, Counter()
    for r in rows:
        size[r.source] += r._size
        target[r.source] = r._target
        taken[r.source] += r._size * len(r._draws)
        assert len(r._draws) <= 3 and len({d["pass"] for d in r._draws}) == len(r._draws)
        assert r._size == len((r.text or "").split())
    assert all(r._source_size == size[r.source] for r in rows)
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    level = {s: target[s] / weight[s] for s in size}
    for s in size:  # below its cap every source stands at the same level
        assert target[s] <= 3 * size[s] + 1e-9
        assert math.isclose(level[s], max(level.values())) or math.isclose(target[s], 3 * size[s])
        assert abs(taken[s] - target[s]) <= max((r._size for r in rows if r.source == s), default=0)
    again = mixing_plan(documents.repartition(5), block_words=100, shard_words=500).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))
    mixed = mix_sources(documents)
    assert mixed.columns == documents.columns and mixed.count() == sum(len(r._draws) for r in rows)
    assert mixing_plan(empty).count() == 0 and mix_sources(empty).count() == 0
    blank = documents.withColumn("text", F.lit(" "))
    assert {(r._target, len(r._draws)) for r in mixing_plan(blank).collect()} == {(0.0, 0)}


def test_quotas_add_up(spark):
    total = [70, 31, 5, 0, 94]
    leaves = shard_quotas(spark.createDataFrame([(total,)], "quotas array<long>"), 7, 1).collect()
    assert [sum(c) for c in zip(*(r.quotas for r in leaves))] == total
    assert {r.shard for r in leaves} == set(range(7)) and {sum(r.quotas) for r in leaves} <= {28, 29}


def test_hypergeometric_law(spark):
    n = 4000
    args = [F.lit(x).cast("long") for x in (50, 20, 15)]
    found = spark.range(n).select(_hypergeometric(*args, (F.col("id") + 0.5) / n).alias("x")).groupBy("x").count().collect()
    for r in found:
        exact = math.comb(20, r.x) * math.comb(30, 15 - r.x) / math.comb(50, 15)
        assert abs(r["count"] / n - exact) < 2 / n


def test_mix_of_clashing_columns(documents):
    """Columns named like the operator's own stay in the mix, and give way to its facts in the plan."""
    own = ["_src", "_k", "_size", "_block", "_list", "_draws", "_cut", "c0"]
    clash = documents.withColumns({c: F.col("id") for c in own})
    mixed = mix_sources(clash)
    assert mixed.columns == clash.columns
    assert all(r[c] == r.id for r in mixed.collect() for c in own)
    assert sorted(r.doc_id or -1 for r in mixed.collect()) == sorted(r.doc_id or -1 for r in mix_sources(documents).collect())
    plan = mixing_plan(clash)
    assert sorted(plan.columns) == sorted({*clash.columns, "_source_size", "_target"})
    facts = ["doc_id", "_size", "_source_size", "_target"]
    assert sorted(map(repr, plan.select(facts).collect())) == sorted(map(repr, mixing_plan(documents).select(facts).collect()))


# --- op 9 ---------------------------------------------------------------------------------

def brute_links(data, cosine=0.93):
    usable = [
        (k, np.array(v, dtype=np.float64), l) for k, v, l in data
        if l is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    links, parent = Counter(), {k: k for k, _, _ in data}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i, (a, x, l) in enumerate(usable):
        for b, y, m in usable[:i]:
            if l == m and len(x) == len(y) and x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                links[a] += 1
                links[b] += 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    return sorted((k, links[k], root(k), root(k) == k) for k, _, _ in data)


def test_vector_links(spark, rng):
    centres = rng.standard_normal((12, 16))
    data = [(i, [float(x) for x in np.float32(c * rng.uniform(0.5, 3) + 0.25 * rng.standard_normal(16))], i % 2) for i, c in enumerate(np.repeat(centres, 25, axis=0))]
    data += [(500 + i, data[0][1], 0) for i in range(30)]
    data += [
        (600, None, 0), (601, [0.0] * 16, 0), (602, [1.0] * 15 + [None], 0), (603, [float("nan")] * 16, 0), (604, [float("inf")] * 16, 1),
        (605, data[3][1], None), (606, [], 0), (607, [1.0, 2.0], 0), (608, [2.0, 4.0], 0), (609, [3.0], 1), (610, [5.0], 1), (611, [-5.0], 1),
    ]
    df = spark.createDataFrame([(*r, "x") for r in data], "vec_id long, embedding array<float>, label int, links string").repartition(4)
    found = sorted(tuple(r) for r in vector_links(df).collect())
    expected = brute_links(data)
    lost = sum(e[1] for e in expected) - sum(f[1] for f in found)
    assert lost <= 0.001 * sum(e[1] for e in expected)
    assert all(f[1] <= e[1] for f, e in zip(found, expected))
    assert [f for f in found if f[0] >= 500] == [e for e in expected if e[0] >= 500]
    assert vector_links(df.limit(0)).count() == 0
    nameless = df.where("vec_id < 50").unionByName(df.where("vec_id = 0").withColumn("vec_id", F.lit(None).cast("long")))
    rows = {r.vec_id: tuple(r) for r in vector_links(nameless).collect()}
    assert rows.pop(None) == (None, 0, None, True)
    assert rows == {r.vec_id: tuple(r) for r in vector_links(df.where("vec_id < 50")).collect()}


def test_recall_of_links(spark, rng):
    """20,000 vectors, most pairs near the threshold: at least 0.999 of the links, none below it."""
    n, dim = 20_000, 32
    base = rng.standard_normal((n // 4, dim))
    noise = rng.standard_normal((n, dim)) * rng.choice([0.2, 0.25, 0.3], size=(n, 1))
    x = np.float32(np.repeat(base, 4, axis=0) + noise)
    label = np.repeat(rng.integers(0, 4, n // 4), 4)
    unit = x.astype(np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    expected = np.zeros(n, dtype=np.int64)
    for l in range(4):
        own = np.flatnonzero(label == l)
        near = unit[own] @ unit[own].T >= 0.93
        expected[own] = near.sum(axis=1) - 1
    rows = [(i, v, int(l)) for i, (v, l) in enumerate(zip(x.tolist(), label))]
    found = vector_links(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(8)).collect()
    got = np.zeros(n, dtype=np.int64)
    got[[r.vec_id for r in found]] = [r.n_links for r in found]
    assert expected.sum() > n / 2 and (got <= expected).all()
    assert got.sum() >= 0.999 * expected.sum()


def test_listing_finds_every_passed_filter(rng, monkeypatch):
    code = choose_code(24, 2000, 0.93)
    monkeypatch.setattr(capfilters, "DECODE_BYTES", 32 * code.words * 7)  # blocks of seven rows
    unit = rng.standard_normal((40, 24))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    codes = [code.parts(n) for n in range(capfilters.CODES)]
    for u, listed in zip(unit, code.passed(unit)):
        score = np.concatenate([np.add.outer(a @ (u @ q)[:12], b @ (u @ q)[12:]).reshape(-1) for q, a, b in codes])
        assert set(np.flatnonzero(score >= code.threshold + 1e-12)) <= set(listed.tolist())
        assert len(listed) <= (score >= code.threshold - 1e-12).sum() + capfilters.TOP * capfilters.CODES
        assert (np.diff(listed) > 0).all()


# --- pipeline -----------------------------------------------------------------------------

def test_pipeline(spark, documents, empty, tmp_path):
    """Each stage against what its operator is tested for: who goes, who stays, and the columns."""
    docs = documents
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
    ids = {n: Counter(r.id for r in d.collect()) for n, d in seen.items() if n != "packing"}
    letters = {r.id for r in documents.collect() if any(c.isalpha() for c in r.text or "")}
    assert set(ids["language_id"]) == letters and ids["language_id"]["k10"] == 2
    assert all(d.columns == documents.columns for n, d in seen.items() if n != "packing")
    assert ids["simhash_near_dedup"]["k10"] == 1 and "k1" not in ids["simhash_near_dedup"]
    assert max(ids["mixing_sources"].values()) <= 3
    tokens = sum(r.length for r in seen["packing"].collect())
    assert tokens > 0 and {r.doc_id for r in seen["packing"].collect()} == {r.doc_id for r in seen["mixing_sources"].collect()}
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_archive_member_names(tmp_path, spark):
    """Several archives in a package, each with its own index."""
    raw = [warc.record(i, f"u{i}", b"x" * i, hashlib.sha256(b"x" * i).hexdigest(), None) for i in range(4)]
    path = tmp_path / "two.zip"
    with zipfile.ZipFile(path, "w") as z:
        for half in (0, 1):
            body, lines = io.BytesIO(), []
            for r in raw[2 * half : 2 * half + 2]:
                packed = gzip.compress(r)
                lines.append(f"{body.tell()} {len(packed)}")
                body.write(packed)
            z.writestr(f"archive/a{half}.warc.gz", body.getvalue())
            z.writestr(f"indexes/a{half}.cdx", "\n".join(lines) + "\n")
    found = warc.read_packages(spark.createDataFrame([(f"file://{path}",)], "path string")).collect()
    assert sorted((r.page_id, r.payload_bytes) for r in found) == [(i, i) for i in range(4)]
