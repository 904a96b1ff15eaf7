"""The queries of this package over the driver's tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from truegrain.llm.chosen_path import similar_documents
from truegrain.llm.common import small_batches
from truegrain.llm.divergence import divergence
from truegrain.llm.exact_dedup import copy_groups
from truegrain.llm.language import predict_language
from truegrain.llm.mixing import mix_report
from truegrain.llm.neighbours import nearest_neighbours
from truegrain.llm.packing import pack
from truegrain.llm.pii import replace_personal_data
from truegrain.llm.sharding import shard_documents
from truegrain.llm.simhash import near_duplicates
from truegrain.llm.spelling import spelling_variants
from truegrain.llm.token_output import packed_rows
from truegrain.llm.toxicity import score_toxicity
from truegrain.session import load

#: The key of the surrogates; a caller with data to protect gives a secret one.
SURROGATE_KEY = b"surrogates of the public test tables"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(load(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = copy_groups(load(spark, sf_dir, "documents"), all_hashes=True)
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.col("text_hash").alias("text_sha256"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predict_language(load(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(load(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(load(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return score_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op7_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_personal_data(load(spark, sf_dir, "documents"), SURROGATE_KEY)


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"))


def op9_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_rows(load(spark, sf_dir, "documents"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = load(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors.filter("vec_id % 100 = 0"), vectors)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(load(spark, sf_dir, "documents"))


def op12_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_documents(load(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(load(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_exact_dedup, op3_language, op4_packing, op5_sharding, op6_toxicity, op7_surrogates, op8_simhash, op9_packed_ids, op10_neighbours, op11_source_divergence, op12_chosen_path, op13_spelling_variants)}

ORACLES = {
    "op1_mix_sources": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, ''))), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
            FROM documents
        ), totals AS (
            SELECT source, sum(size)::BIGINT AS total, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::DOUBLE AS weight
            FROM sized GROUP BY source
        ), running AS (
            SELECT *, coalesce(sum(total) OVER before, 0)::DOUBLE AS total_before, coalesce(sum(weight) OVER before, 0) AS weight_before,
                   (SELECT sum(total) FROM totals)::DOUBLE AS everything, (SELECT sum(weight) FROM totals) AS weights
            FROM totals WINDOW before AS (ORDER BY total::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
        ), cuts AS (
            SELECT *, 3 * total::DOUBLE * (weights - weight_before) < (everything - 3 * total_before) * weight AS cut FROM running
        ), targets AS (
            SELECT source, total, CASE WHEN cut THEN 3 * total::DOUBLE ELSE
                weight * (everything - 3 * coalesce((SELECT sum(total) FROM cuts WHERE cut), 0)::DOUBLE) / (SELECT sum(weight) FROM cuts WHERE NOT cut) END AS target
            FROM cuts
        ), rates AS (SELECT *, CASE WHEN total > 0 THEN target / total ELSE 0 END AS rate FROM targets),
        turned AS (
            SELECT sized.*, rates.total, rates.target, turn, (floor(rate) + CASE WHEN draw + turn - floor(draw + turn) < rate - floor(rate) THEN 1 ELSE 0 END)::INTEGER AS copies
            FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source CROSS JOIN (SELECT range / 32.0::DOUBLE AS turn FROM range(32))
        ), seeds AS (
            SELECT source, turn FROM turned GROUP BY source, target, turn
            QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(sum(size * copies)::DOUBLE - target), turn) = 1
        ), counted AS (
            SELECT doc_id, size, total AS source_size, target, copies
            FROM turned JOIN seeds ON turned.source IS NOT DISTINCT FROM seeds.source AND turned.turn = seeds.turn
        )
        SELECT doc_id, size, source_size, target, copies, size * copies AS taken FROM counted
    """,
    "op2_exact_dedup": """
        WITH hashed AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents
        ), grouped AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM hashed GROUP BY text_sha256)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM hashed JOIN grouped USING (text_sha256)
    """,
    "op10_neighbours": """
        WITH vectors AS (
            SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), measured AS (
            SELECT q.vec_id AS query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda s, x: s + x)) AS score
            FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)::INTEGER AS rank FROM measured)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
    """,
    "op11_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
            FROM documents
        ), words AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
        kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
        counted AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term),
        groups AS (
            SELECT lang, source, (SELECT coalesce(sum(n), 0) FROM counted c WHERE c.lang = g.lang AND c.source = g.source) AS n_group,
                   (SELECT count(*) FROM kept k WHERE k.lang = g.lang) AS v, (SELECT coalesce(sum(total), 0) FROM kept k WHERE k.lang = g.lang) AS n_lang
            FROM (SELECT DISTINCT lang, source FROM docs) g
        ), shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.n_group + g.v))::BIGINT AS p,
                   (1 + 1000000000::HUGEINT * (k.total + 1) // (g.n_lang + g.v))::BIGINT AS q
            FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
        ), valued AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE n > 0 AND p > q
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM valued)
        SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
    """,
}
