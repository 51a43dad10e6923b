"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import align, bpe, langid, linedup, minhash, packing, phrases, pii, quality, simhash, topk, toxicity, winnow
from .common import remainder

KEY = "beaconmill"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(bpe.encode_documents(table(spark, sf_dir, "documents")))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.with_statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    model = quality.fit_quality(stats, table(spark, sf_dir, "labels"))
    scored = quality.score_quality(stats, model)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, machine)
    return scored.select("doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprint_neighbours(table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit_languages(docs)
    found = langid.predict_language(docs.select("doc_id", "text"), model)
    return found.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return linedup.deduplicate_lines(docs, least_exact=1, max_bits=None).select("doc_id", "lines_dropped", "text")


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace_pii(docs, KEY).select("doc_id", "entities_replaced", "text")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_documents(table(spark, sf_dir, "documents"))


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.minhash_groups(table(spark, sf_dir, "documents"), width=3, percent=85)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe, op2_quality, op3_toxicity, op4_winnowing, op5_language, op6_line_dedup, op7_top_k, op8_pii, op9_simhash, op10_packing,
        op11_alignment, op12_minhash, op13_collocations,
    )
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# Exact search, set similarity and counts are SQL; the others are models or a library's ids.
ORACLE_SQL: dict[str, str] = {
    "op7_top_k": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
        )
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
        ) WHERE rank <= 20
    """,
    "op12_minhash": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) BETWEEN 1 AND 2 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w
        ),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS sh FROM s),
        pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.sh = b.sh AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
        ),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, p.y FROM reach r JOIN pairs p ON p.x = r.b
        ),
        low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN low ON a = doc_id
    """,
    "op13_collocations": rf"""
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
        w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
        n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
        starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
        grams AS (SELECT lang, w[i : i + k - 1] AS ws, k FROM starts, range(1, 6) AS r(k) WHERE i + k - 1 <= len(w)),
        f AS (SELECT lang, array_to_string(ws, ' ') AS phrase, any_value(ws) AS ws, any_value(k) AS k, count(*) AS f FROM grams GROUP BY ALL),
        c AS (SELECT * FROM f WHERE k > 1 AND f >= 100),
        own AS (
            SELECT * FROM c WHERE NOT EXISTS (
                SELECT 1 FROM c AS d WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.f >= 100 * c.f
                AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))
        ),
        cuts AS (SELECT *, unnest(range(1, k)) AS cut FROM own),
        scored AS (
            SELECT cuts.lang, cuts.phrase, cuts.f AS a, x.f AS l, y.f AS r, n.n, cut,
                CAST((CAST(1000 AS HUGEINT) * cuts.f * n.n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
            FROM cuts JOIN n ON n.lang = cuts.lang
            JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.ws[1 : cut], ' ')
            JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.ws[cut + 1 :], ' ')
        ),
        low AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low)
        SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
    """,
}
