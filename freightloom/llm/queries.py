"""Registered queries of the text operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from freightloom.llm import bpe, centroids, chat, decontaminate, language, neighbours, personal, phrases, quality, token_shards
from freightloom.llm.common import kept, table, workspace
from freightloom.llm.exact_dedup import exact_dedup
from freightloom.llm.line_dedup import line_dedup
from freightloom.llm.simhash import simhash_dedup

#: Tokenizer file of the registered queries, one of the public ones installed beside the libraries.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), workspace(spark)
    token_shards.write_shards(docs, tokenizer(), path, END_ID)
    return token_shards.fetch(spark, path, token_shards.all_keys(docs), with_ids=False).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), workspace(spark)).drop("row", "n_chunks")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"), workspace(spark))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document and item of each match; documents without one do not occur."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op6_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return personal.span_digests(personal.find(docs, personal.learn(docs)))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts are made of the template's own control strings."""
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).selectExpr(
        "CAST(-1 AS BIGINT) AS conv_id", "id AS turn", "if(id = 0, 'user', 'assistant') AS role",
        "'</s>[INST] ok [/INST]' AS text")
    segments = chat.format_chats(chats.unionByName(probe), chat.INSTRUCTIONS)
    return chat.chat_digests(kept(segments, workspace(spark), "segments"), chat.INSTRUCTIONS)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict_documents(docs, language.learn(docs))


def op8_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), tokenizer())
    return bpe.coding_digests(encoded, tokenizer())


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(table(spark, sf_dir, "documents"), workspace(spark)).drop("row", "kept")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), workspace(spark))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"), workspace(spark))


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of each vector whose id 20 divides."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), workspace(spark), k=20, every=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_token_shards, op2_exact_dedup, op3_line_dedup, op4_decontaminate, op5_quality, op6_personal, op7_chat_format,
        op8_bpe_coding, op9_simhash, op10_language, op11_phrases, op12_centroids, op13_neighbours)
}


def _phrase_sql(least: int = phrases.LEAST, top: int = phrases.TOP) -> str:
    """All word sequences of one to four, counted; cuts and longer phrases by joins on phrases."""
    return rf"""
        WITH pieces AS MATERIALIZED (
            SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
        words AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
        spots AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i, size FROM words, (VALUES (1), (2), (3), (4)) t(size)),
        totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
        freq AS MATERIALIZED (
            SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS f
            FROM spots WHERE i + size - 1 <= len(w) GROUP BY ALL HAVING count(*) >= {least}),
        cuts AS (
            SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, size)) AS k FROM freq WHERE size > 1),
        rated AS (
            SELECT c.lang, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
                   ({phrases.SCALE}::HUGEINT * c.a) // (x.f::HUGEINT + y.f) AS score
            FROM cuts c
            JOIN freq x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:c.k], ' ')
            JOIN freq y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[c.k + 1:], ' ')
            QUALIFY row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY score, c.k) = 1),
        spans AS (
            SELECT lang, string_split(phrase, ' ') AS w, f, i, m
            FROM freq, (VALUES (1, 2), (2, 2), (3, 2), (1, 3), (2, 3)) t(i, m) WHERE m < size AND i + m - 1 <= size),
        longer AS (
            SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS most FROM spans GROUP BY ALL),
        stay AS (
            SELECT r.* FROM rated r LEFT JOIN longer g ON g.lang = r.lang AND g.phrase = r.phrase
            WHERE g.most IS NULL OR 100::HUGEINT * g.most < {phrases.COVERS}::HUGEINT * r.a)
        SELECT s.lang, row_number() OVER best AS rank, s.phrase, s.a, s.l, s.r, t.n, s.score::BIGINT AS score
        FROM stay s JOIN totals t ON t.lang = s.lang
        WINDOW best AS (PARTITION BY s.lang ORDER BY s.score DESC, s.a DESC, s.phrase)
        QUALIFY row_number() OVER best <= {top}"""


def _centroid_sql(clusters: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS) -> str:
    """Assignment and averaging of each round as two table expressions."""
    size, bound = centroids.SIZE, centroids.BOUND // centroids.SCALE
    steps = [f"""
        v AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS e, row_number() OVER () AS row
            FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(
                embedding, lambda x: x IS NOT NULL AND isfinite(x) AND abs(x::DOUBLE) < {bound})) = {size}),
        c0 AS MATERIALIZED (
            SELECT row_number() OVER first - 1 AS k, e FROM v
            WINDOW first AS (ORDER BY sha256('{centroids.SEED}:' || coalesce(vec_id::VARCHAR, '')), e) QUALIFY k < {clusters})"""]
    for i in range(rounds + 1):
        steps.append(f"""
        a{i} AS MATERIALIZED (
            SELECT row, vec_id, v.e, k, list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
            FROM v, c{i} c QUALIFY row_number() OVER (PARTITION BY row ORDER BY d, k) = 1)""")
        if i < rounds:
            steps.append(f"""
        s{i} AS (
            SELECT k, i, sum(x)::HUGEINT AS s, count(*)::HUGEINT AS n
            FROM (SELECT k, unnest(e) AS x, unnest(range({size})) AS i FROM a{i}) GROUP BY k, i),
        c{i + 1} AS MATERIALIZED (
            SELECT c.k, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN (
                SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS e FROM s{i} GROUP BY k) m ON m.k = c.k)""")
    return f"""WITH {",".join(steps)}
        SELECT vec_id, a.k::INTEGER AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY a.k))::BIGINT AS cluster_inertia,
               (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c ON c.k = a.k"""


SQL: dict[str, str] = {
    "op11_phrases": _phrase_sql(),
    "op12_centroids": _centroid_sql(),
    "op2_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               row_number() OVER (PARTITION BY body ORDER BY doc_id) = 1 AS kept, sha256(body) AS text_sha256
        FROM t WINDOW same AS (PARTITION BY body)""",
}
