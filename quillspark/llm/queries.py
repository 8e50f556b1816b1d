"""The registered queries of this package: thin wrappers that give the operators the supplied tables and production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat_format, cross_polytope, hard_negatives, html_text, langid, mixing, near_vectors, packing, repeated_spans, shingle_join, spelling_variants, surrogates, warc

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_warc_captures(spark: SparkSession, folder: str) -> DataFrame:
    return warc.digest_rows(warc.round_trip(table(spark, folder, "pages")))


def op3_pii_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    return surrogates.with_surrogates(table(spark, folder, "documents")).select("doc_id", "n_entities", "text")


def op4_repeated_spans(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_spans.remove_repeats(table(spark, folder, "documents"), window=200)


def op5_near_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return near_vectors.near_duplicates(table(spark, folder, "embeddings"), cosine=0.98)


def op6_nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    return cross_polytope.search(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_html_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return shingle_join.jaccard_components(table(spark, folder, "documents"), percent=80, words=5)


def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.group_variants(table(spark, folder, "documents"), damage=199)


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings").withColumn("label", label), F.col("vec_id") % 100 == 0)


def op13_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    hard = "</s>[INST] ok [/INST]"
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    turns = turns.unionByName(spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], turns.schema))
    return chat_format.digests(chat_format.read_back(chat_format.format_log(chat_format.turn_events(turns))))


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_warc_captures": op2_warc_captures,
    "op3_pii_surrogates": op3_pii_surrogates,
    "op4_repeated_spans": op4_repeated_spans,
    "op5_near_vectors": op5_near_vectors,
    "op6_nearest_vectors": op6_nearest_vectors,
    "op7_html_main_text": op7_html_main_text,
    "op8_mix_sources": op8_mix_sources,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language_id": op10_language_id,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_chat_format": op13_chat_format,
}
NIBBLE = "(strpos('0123456789abcdef', substr(h, {0}, 1)) - 1)"
BASE32 = " || ".join(
    f"substr('{warc.BASE32}', ((({NIBBLE.format(5 * i // 4 + 1)} * 16 + {NIBBLE.format(5 * i // 4 + 2)}) >> {3 - 5 * i % 4}) & 31)::INT + 1, 1)"
    for i in range(32))
SQL: dict[str, str] = {
    "op9_jaccard_join": r"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: hash(array_to_string(w[i:i + 4], ' '))))
                WHEN len(w) > 0 THEN [hash(array_to_string(w, ' '))] ELSE [] END AS s FROM w),
        u AS (SELECT doc_id, unnest(s) AS x FROM s),
        c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM u a JOIN u b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
        near AS (SELECT a, b FROM c JOIN s p ON p.doc_id = a JOIN s q ON q.doc_id = b WHERE 100 * n >= 80 * (len(p.s) + len(q.s) - n)),
        links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
        reach AS (SELECT doc_id AS node, doc_id AS found FROM s UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.found)
        SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, r.c AS component_id
        FROM s JOIN (SELECT node, min(found) AS c FROM reach GROUP BY node) r ON r.node = s.doc_id""",
    "op5_near_vectors": """
        WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND list_sum(list_transform(embedding, lambda x: abs(x))) > 0),
        links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reach AS (SELECT vec_id AS node, vec_id AS found FROM v UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.found)
        SELECT e.vec_id, coalesce(n.n, 0) AS n_links, coalesce(c.c, e.vec_id) AS component_id, e.vec_id = coalesce(c.c, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) n ON n.a = e.vec_id
        LEFT JOIN (SELECT node, min(found) AS c FROM reach GROUP BY node) c ON c.node = e.vec_id""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 100 = 0),
        p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, id AS negative_id, positive_score, score AS negative_score
        FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) QUALIFY row_number() OVER w <= 5""",
    "op2_warc_captures": f"""
        WITH hashed AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
        digests AS (SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, {BASE32} AS payload_digest FROM hashed),
        firsts AS (SELECT payload_digest, max(page_id) AS first FROM digests GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM digests JOIN firsts USING (payload_digest)""",
}
