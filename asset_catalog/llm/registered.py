"""One query for each operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asset_catalog.llm import alignment, ann, embed_dedup, langid, lm_score, merkle, mixing, quality, sentencepieces, simhash, substring_dedup, token_scan, toxicity
from asset_catalog.llm.common import fold, table


def _judged(scored: DataFrame, modulus: int, held_out: int) -> DataFrame:
    return scored.select(
        "doc_id",
        (fold(F.col("doc_id"), modulus) == held_out).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    machine = toxicity.learn(documents, table(spark, sf_dir, "labels"), modulus=5, held_out=0)
    return _judged(toxicity.score_toxicity(documents, machine), 5, 0)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("source")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality.learn(documents, table(spark, sf_dir, "labels"), modulus=3, held_out=1)
    return _judged(quality.score_quality(documents, model), 3, 1)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    named = langid.identify(documents, langid.learn(documents, modulus=5, held_out=0))
    return named.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.link_vectors(table(spark, sf_dir, "embeddings"), least=0.98)


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, most=20)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.count_tokens(table(spark, sf_dir, "documents"), token_scan.load())


def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, most_bits=2)


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold(F.col("doc_id"), 7) == 2
    scored = lm_score.score_all(table(spark, sf_dir, "documents"), ~held_out)
    score = -F.col("bits") * F.lit(math.log10(2))
    rows = scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", score.alias("score"), "n_bytes")
    return rows.withColumn("bits_per_byte", -F.col("score") / F.lit(math.log10(2)) / (F.col("n_bytes") + 1))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"), sentencepieces.load())


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    aligned = alignment.align(documents, alignment.load(), keep=lambda groups: F.when(groups == "", "").otherwise(F.sha2(groups, 256)))
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35)
    return cut.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text, letters = F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    tampered = F.when(chosen, F.translate(text, letters, letters.lower())).otherwise(text)
    proofs = merkle.prove(merkle.build(table(spark, sf_dir, "documents"), claims={"text": tampered}))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_source_mix": op2_source_mix,
    "op3_quality": op3_quality,
    "op4_language": op4_language,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_nearest": op6_nearest,
    "op7_token_counts": op7_token_counts,
    "op8_simhash_dedup": op8_simhash_dedup,
    "op9_lm_score": op9_lm_score,
    "op10_sentencepiece": op10_sentencepiece,
    "op11_alignment": op11_alignment,
    "op12_substring_dedup": op12_substring_dedup,
    "op13_merkle": op13_merkle,
}

ORACLES = {
    "op2_source_mix": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce('=' || source, '') AS source_key,
                   md5('mix' || coalesce(doc_id::VARCHAR, '')) AS mix_key,
                   coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents),
        s AS (
            SELECT source_key, sum(size)::BIGINT AS source_size,
                   [5, 2, 1][(row_number() OVER (ORDER BY any_value(source) NULLS LAST) - 1) % 3 + 1] AS weight
            FROM d GROUP BY source_key),
        r AS (
            SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS ratio,
                   sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE AS wanted
            FROM s),
        l AS (
            SELECT *, (wanted - coalesce(sum(cap) OVER (ORDER BY ratio, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
                   / sum(weight) OVER (ORDER BY ratio, source_key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
            FROM r),
        o AS (SELECT min(level) FILTER (level < ratio AND ratio = first_open) AS open_level
              FROM (SELECT *, min(ratio) FILTER (level < ratio) OVER () AS first_open FROM l)),
        t AS (
            SELECT source_key, source_size,
                   CASE WHEN open_level IS NULL OR ratio <= open_level THEN cap::DOUBLE ELSE open_level * weight END AS target
            FROM l, o),
        b AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS turns
            FROM t),
        g AS (SELECT source_key, mix_key, sum(size)::BIGINT AS words FROM d GROUP BY ALL),
        p AS (
            SELECT *, (sum(words) OVER (PARTITION BY source_key ORDER BY mix_key) - words)::BIGINT AS start
            FROM g)
        SELECT doc_id, size, source_size, target,
               (size * turns + CASE WHEN words = 0 THEN 0 ELSE floor(
                   size * least(greatest(floor(target)::BIGINT - turns * source_size - start, 0), words) / words) END)::BIGINT AS taken
        FROM d JOIN b USING (source_key) JOIN p USING (source_key, mix_key)""",
    "op5_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
              AND list_bool_or(list_transform(embedding, lambda x: x != 0))),
        links AS (
            SELECT a.vec_id, b.vec_id AS other FROM v a JOIN v b
            ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id != b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        reached AS (
            SELECT vec_id, vec_id AS other FROM embeddings
            UNION
            SELECT r.vec_id, l.other FROM reached r JOIN links l ON l.vec_id = r.other),
        found AS (SELECT vec_id, count(*) AS n FROM links GROUP BY vec_id)
        SELECT r.vec_id, coalesce(any_value(f.n), 0)::BIGINT AS n_links, min(r.other) AS component_id,
               r.vec_id = min(r.other) AS kept
        FROM reached r LEFT JOIN found f ON f.vec_id = r.vec_id GROUP BY r.vec_id""",
    "op12_substring_dedup": r"""
        WITH d AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
        w AS (
            SELECT row, place, hash(passage) AS key, passage
            FROM (SELECT row, place, array_to_string(words[place:place + 34], ' ') AS passage
                  FROM (SELECT row, words, unnest(generate_series(1, len(words) - 34)) AS place FROM d))),
        again AS (SELECT row, place AS first FROM w QUALIFY count(*) OVER (PARTITION BY key, passage) > 1),
        gone AS (SELECT DISTINCT row, unnest(generate_series(first, first + 34)) AS place FROM again),
        held AS (SELECT row, list(place) AS places FROM gone GROUP BY row)
        SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
               sha256(array_to_string(CASE WHEN places IS NULL THEN words
                   ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
        FROM d LEFT JOIN held USING (row)""",
    "op13_merkle": r"""
        WITH RECURSIVE d AS (
            SELECT row_number() OVER () AS row, doc_id, coalesce('=' || source, '') AS tree, text,
                   coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                       || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head,
                   list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ord(c), -1, -1, -1, -1, -1, -1, -1, -1]))::BIGINT[],
                       lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) WHEN crc % 2 = 1 THEN xor(crc // 2, 3988292384) ELSE crc // 2 END,
                       4294967295::BIGINT) AS crc
            FROM documents),
        c AS (
            SELECT *, CASE WHEN xor(crc, 4294967295) % 5 = 0
                      THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed
            FROM d),
        l AS (
            SELECT row, doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   sha256(head || coalesce(strlen(changed) || ':' || changed, '-')) AS claimed
            FROM c),
        p AS (
            SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY tree) AS n
            FROM l),
        up AS (
            SELECT 0 AS level, tree, pos, n, leaf AS digest FROM p
            UNION ALL
            SELECT level + 1, tree, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
            FROM up WHERE n > 1 GROUP BY level, tree, pos // 16),
        subroots AS (
            SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS sources
            FROM up WHERE n = 1),
        top AS (
            SELECT 0 AS level, '>' AS tree, place AS pos, sources AS n, subroot AS digest FROM subroots
            UNION ALL
            SELECT level + 1, tree, pos // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY pos))
            FROM top WHERE n > 1 GROUP BY level, tree, pos // 16),
        nodes AS (
            SELECT level, tree, pos, n,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lefts,
                   coalesce(string_agg(digest, '') OVER (run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rights
            FROM (FROM up UNION ALL FROM top) WINDOW run AS (PARTITION BY level, tree, pos // 16 ORDER BY pos)),
        climb AS (
            SELECT row, 0 AS level, tree, pos, claimed AS folded, '' AS proof, false AS arrived FROM p
            UNION ALL
            SELECT c.row, CASE WHEN k.n > 1 THEN c.level + 1 ELSE 0 END, CASE WHEN k.n > 1 THEN c.tree ELSE '>' END,
                   CASE WHEN k.n > 1 THEN c.pos // 16 ELSE s.place END,
                   CASE WHEN k.n > 1 THEN sha256(lefts || folded || rights) ELSE folded END,
                   CASE WHEN k.n > 1 THEN proof || lefts || rights ELSE proof END,
                   k.n = 1 AND c.tree = '>'
            FROM climb c JOIN nodes k USING (level, tree, pos) LEFT JOIN subroots s ON s.tree = c.tree
            WHERE NOT arrived)
        SELECT p.doc_id, p.leaf, s.subroot, r.digest AS root, sha256(c.proof) AS proof_sha256, c.folded AS folded_root, c.folded = r.digest AS verified
        FROM p JOIN climb c ON c.row = p.row AND c.arrived JOIN subroots s ON s.tree = p.tree, (SELECT digest FROM top WHERE n = 1) r""",
}
