"""The registered queries of this subpackage: ``{name: (run(spark, sf_dir), DuckDB SQL or None)}``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nearfield.llm.capfilters import vector_links
from nearfield.llm.conversations import repair_digest
from nearfield.llm.decontaminate import contamination_digest, index_items
from nearfield.llm.importance import importance_ranks
from nearfield.llm.kneserney import fit_ngrams, score_texts
from nearfield.llm.langid import fit_languages, identify_languages
from nearfield.llm.mixing import mixing_plan
from nearfield.llm.packing import pack_documents
from nearfield.llm.simhash import simhash_groups
from nearfield.llm.substring import substring_digest
from nearfield.llm.syncmers import fingerprint_edits
from nearfield.llm.tokenfile import read_token_files, write_token_files
from nearfield.llm.warc import read_packages, write_packages
from nearfield.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fold(n: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def op1_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_token_files(write_token_files(documents(spark, sf_dir), scratch_path(spark, "ids")))


SQL_OP2 = r"""
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
    SELECT doc_id, p, md5(array_to_string(w[p:p + 12], ' ')) AS h
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM words)
), firsts AS (
    SELECT h, min(doc_id) AS first_id FROM windows GROUP BY h
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS p
    FROM windows JOIN firsts USING (h) WHERE doc_id > first_id
), lists AS (
    SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_filter(w, lambda x, i: ps IS NULL OR NOT list_contains(ps, i)), ' '))
           AS kept_sha256
FROM words LEFT JOIN lists USING (doc_id)
"""


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_digest(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir))


SQL_OP4 = """
WITH facts AS (
    SELECT page_id, coalesce(strlen(html), 0) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (
    SELECT payload_digest, min(page_id) AS first_id FROM facts WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND first_id != page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id != page_id THEN first_id END AS refers_to
FROM facts LEFT JOIN firsts USING (payload_digest)
"""


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    packages = write_packages(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_packages(packages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(documents(spark, sf_dir))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", fold(5) == 0)
    model = fit_languages(docs.where(~F.col("held_out")), sample_key=F.col("doc_id"))
    return identify_languages(docs, model, keep=["held_out"])


SQL_OP7 = r"""
WITH sized AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
           substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS k
    FROM documents
), per AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
    FROM sized GROUP BY source
), levels AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS DOUBLE)
              / CAST(sum(w) OVER after AS DOUBLE) AS level
    FROM per
    WINDOW before AS (ORDER BY 3 * source_size / w, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           after AS (ORDER BY 3 * source_size / w, source NULLS LAST
                     ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
    SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), w * max(level) OVER ()) AS target
    FROM levels
), rests AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM targets
), groups AS (
    SELECT source, k, sum(size) AS g FROM sized GROUP BY source, k
), placed AS (
    SELECT source, k, g, coalesce(sum(g) OVER (PARTITION BY source ORDER BY k
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS c FROM groups
)
SELECT s.doc_id, s.size, r.source_size, r.target,
       CAST(s.size * (r.whole + CASE WHEN p.c + p.g / 2.0 <= r.target - r.whole * r.source_size
                                     THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s
JOIN rests r ON s.source IS NOT DISTINCT FROM r.source
JOIN placed p ON s.source IS NOT DISTINCT FROM p.source AND s.k = p.k
"""


def op7_mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing_plan(documents(spark, sf_dir).select("doc_id", "text", "source"))
    return plan.select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_size") * F.size("_draws")).alias("taken"),
    )


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("held_out", fold(7) == 2)
    return score_texts(docs, fit_ngrams(docs.where(~F.col("held_out")), order=3), keep=["held_out"])


SQL_OP9 = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x != 0)) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id != b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
), reach(id, seen) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION
    SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.seen
), components AS (
    SELECT id, min(seen) AS component_id FROM reach GROUP BY id
), counts AS (
    SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components ON id = vec_id LEFT JOIN counts ON a = vec_id
"""


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings"))


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir))


# Words of a text as op11 and op12 take them.
SQL_TERMS = r"""coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"""

SQL_OP11 = """
WITH words AS (
    SELECT row_number() OVER () AS row_no, doc_id, WORDS AS w FROM documents
), items AS (
    SELECT item_id, w, least(10, len(w)) AS m FROM (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id, WORDS AS w FROM benchmark)
    WHERE len(w) > 0
), wanted AS (
    SELECT DISTINCT item_id, m, array_to_string(w[p:p + m - 1], ' ') AS s
    FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS p FROM items)
), sizes AS (
    SELECT DISTINCT m FROM wanted
), windows AS (
    SELECT row_no, m, p, array_to_string(w[p:p + m - 1], ' ') AS s
    FROM (SELECT row_no, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM words, sizes WHERE len(w) >= m)
), met AS (
    SELECT row_no, m, p, item_id FROM windows JOIN wanted USING (m, s)
), hits AS (
    SELECT row_no, count(DISTINCT p) AS n_hit FROM (SELECT row_no, unnest(range(p, p + m)) AS p FROM met) GROUP BY row_no
), found AS (
    SELECT row_no, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
    FROM (SELECT DISTINCT row_no, item_id FROM met) GROUP BY row_no
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       n_hit IS NOT NULL AS contaminated
FROM words LEFT JOIN hits USING (row_no) LEFT JOIN found USING (row_no)
""".replace("WORDS", SQL_TERMS)


def op11_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_digest(documents(spark, sf_dir), index_items(table(spark, sf_dir, "benchmark")))


SQL_OP12 = """
WITH RECURSIVE bits AS (
    SELECT i, 0 AS step, i AS r FROM range(256) t(i)
    UNION ALL
    SELECT i, step + 1, CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END FROM bits WHERE step < 8
), register AS (
    SELECT list(r ORDER BY i) AS tab FROM bits WHERE step = 8
), words AS (
    SELECT 0 AS side, doc_id AS id, row_number() OVER () AS row_no, WORDS AS w FROM documents
    UNION ALL
    SELECT 1, NULL, row_number() OVER (), WORDS FROM benchmark
), features AS (
    SELECT side, row_no, unnest(w) AS f FROM words
    UNION ALL
    SELECT side, row_no, unnest(list_transform(list_zip(w[:-2], w[2:]), lambda p: p[1] || ' ' || p[2])) FROM words WHERE len(w) > 1
), counted AS (
    SELECT side, row_no, f, count(*) AS n FROM features GROUP BY ALL
), hashed AS (
    SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(f)), '..'),
               lambda x: ('0x' || x)::BIGINT)),
               lambda c, b: xor(tab[1 + (xor(c, b) & 255)]::BIGINT, c // 256)), 4294967295) % 10000 AS bucket
    FROM (SELECT DISTINCT f FROM counted), register
), placed AS (
    SELECT side, row_no, bucket, n FROM counted JOIN hashed USING (f)
), totals AS (
    SELECT bucket, sum(n) FILTER (side = 0) AS s, sum(n) FILTER (side = 1) AS t FROM placed GROUP BY bucket
), gains AS (
    SELECT bucket, CAST(floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE)
           / ((coalesce(s, 0) + 1)::DOUBLE * (coalesce(sum(t) OVER (), 0) + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM totals
), weights AS (
    SELECT row_no, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS total
    FROM placed JOIN gains USING (bucket) WHERE side = 0 GROUP BY row_no
), scored AS (
    SELECT id AS doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features,
           CASE WHEN n_features IS NULL THEN 0 ELSE (total - ((total % n_features) + n_features) % n_features) // n_features END AS weight,
           CAST(('0x' || substr(sha256('7:' || coalesce(CAST(id AS VARCHAR), '')), 1, 8)) AS BIGINT) AS h
    FROM words LEFT JOIN weights USING (row_no) WHERE side = 0
), noisy AS (
    SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM scored
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
           count(*) FILTER (n_words >= 20) OVER () AS able
    FROM noisy
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CASE WHEN n_words >= 20 AND place <= 25 * able // 100 THEN CAST(place AS BIGINT) END AS "rank"
FROM ranked
""".replace("WORDS", SQL_TERMS)


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_ranks(documents(spark, sf_dir), table(spark, sf_dir, "benchmark")).drop("n_words")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_digest(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_token_id_output": (op1_token_id_output, None),
    "op2_substring_dedup": (op2_substring_dedup, SQL_OP2),
    "op3_packing": (op3_packing, None),
    "op4_warc": (op4_warc, SQL_OP4),
    "op5_document_fingerprints": (op5_document_fingerprints, None),
    "op6_language_id": (op6_language_id, None),
    "op7_mixing_sources": (op7_mixing_sources, SQL_OP7),
    "op8_lm_scoring": (op8_lm_scoring, None),
    "op9_embedding_near_dedup": (op9_embedding_near_dedup, SQL_OP9),
    "op10_simhash_near_dedup": (op10_simhash_near_dedup, None),
    "op11_benchmark_decontamination": (op11_benchmark_decontamination, SQL_OP11),
    "op12_importance_resampling": (op12_importance_resampling, SQL_OP12),
    "op13_conversation_repair": (op13_conversation_repair, None),
}
