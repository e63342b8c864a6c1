"""The registered queries of this subpackage, and their SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframe.llm.common import table
from corpus_pipeline import ORACLE_SQL, run


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from busframe.llm.packing import pack

    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_multiset_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.fingerprint import fingerprints

    found = fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op3_line_block_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.html_text import extract

    return extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])


def op4_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.topk import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op5_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.mixing import mix

    mixed = mix(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op6_kneser_ney_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.kneser_ney import classify

    trusted = table(spark, sf_dir, "labels").where("quality = 1 and toxic = 0")
    return classify(table(spark, sf_dir, "documents"), trusted)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.langid import held_out, predict, train, train_fold

    docs = table(spark, sf_dir, "documents")
    found = predict(docs, train(train_fold(docs)), keep=["doc_id"])
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op9_reply_tree_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.chat import format_replies, read_back, thread

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = r"\### Assistant: </turn> ok"
    rows = rows.unionByName(spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string"))
    talks = read_back(format_replies(thread(rows)))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return talks.select(
        F.col("tree_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.jaccard import components

    return components(table(spark, sf_dir, "documents"))


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.suffix_dedup import dedup

    found = dedup(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.trie import prefix_trie

    return prefix_trie(table(spark, sf_dir, "conversations"))


def op12_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.hamming import search

    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op13_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from busframe.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings"), 4).withColumn("deviation", F.expr("try_cast(deviation AS long)"))


QUERIES = {f.__name__: f for f in (op1_harmonic_packing, op2_multiset_fingerprint, op3_line_block_text, op4_threshold_topk, op5_budget_mix, op6_kneser_ney_quality, op7_language_id, op8_ngram_jaccard, op9_reply_tree_chat, op10_suffix_array_dedup, op11_prefix_trie, op12_multi_index_hashing, op13_polarised_whitening)} | {"pipeline": run}
#: Null texts and roles count as empty, as in the operator; an escaped character is one code point longer.
ORACLES: dict[str, str] = {
    "op4_threshold_topk": """
        WITH whole AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT q.r, q.vec_id AS query_id, c.vec_id, coalesce(list_inner_product(q.v, c.v), 0)::BIGINT AS score
            FROM whole q JOIN whole c ON q.r <> c.r AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored)
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op9_reply_tree_chat": r"""
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(4 + length(role) + len(regexp_extract_all(role, '[\\<#:]')) + 2 + length(text) + len(regexp_extract_all(text, '[\\<#]')) + 8)::BIGINT AS formatted_chars
        FROM said GROUP BY conv_id""",
    "op8_ngram_jaccard": r"""
        WITH RECURSIVE said AS (
            SELECT row_number() OVER () AS r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS (
            SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM said),
        each AS (SELECT r, len(s) AS n, unnest(s) AS x FROM sets),
        links AS (
            SELECT a.r AS a, b.r AS b FROM each a JOIN each b ON a.x = b.x
            GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
        reached AS (SELECT a, b FROM links UNION SELECT x.a, y.b FROM reached x JOIN links y ON x.b = y.a),
        least AS (SELECT a, min(doc_id) AS m FROM reached JOIN sets ON r = b GROUP BY a)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, CASE WHEN len(s) = 0 THEN doc_id ELSE m END AS component_id
        FROM sets LEFT JOIN least ON a = r""".replace(r"\\x", r"\x"),
    "op10_suffix_array_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
        chunks AS (SELECT r, h, unnest(range(0, length(h) // 2 - 199, 500)) AS c FROM d WHERE length(h) >= 400),
        parts AS (SELECT r, c, substr(h, 2 * c + 1, 1398) AS p FROM chunks),
        starts AS (SELECT r, c, p, unnest(range(0, length(p) // 2 - 199)) AS i FROM parts),
        strings AS (SELECT r, c + i AS i, hash(substr(p, 2 * i + 1, 400)) AS m FROM starts),
        twice AS (SELECT m FROM strings GROUP BY m HAVING count(*) > 1),
        hit AS (SELECT r, i FROM strings SEMI JOIN twice USING (m)),
        new AS (SELECT r, i, coalesce(i - lag(i) OVER (PARTITION BY r ORDER BY i) > 200, true)::INT AS first FROM hit),
        runs AS (SELECT r, i, sum(first) OVER (PARTITION BY r ORDER BY i) AS run FROM new),
        spans AS (SELECT r, min(i) AS s, max(i) + 200 AS e FROM runs GROUP BY r, run),
        pieces AS (SELECT r, s, e, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS before FROM spans),
        cut AS (
            SELECT r, sum(e - s) AS removed, count(*) AS n, max(e) AS last, string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) AS kept
            FROM pieces JOIN d USING (r) GROUP BY r)
        SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
            sha256(unhex(CASE WHEN n IS NULL THEN h ELSE kept || substr(h, 2 * last + 1) END)) AS kept_sha256
        FROM d LEFT JOIN cut USING (r)""",
    "op11_prefix_trie": """
        WITH rule AS (SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS step),
        said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        named AS (SELECT *, sha256(length(role) || ':' || role || text) AS name FROM said),
        own AS (SELECT conv_id, list({'name': name, 'size': length(text)} ORDER BY turn NULLS FIRST, role, name) AS t FROM named GROUP BY conv_id),
        numbered AS (
            SELECT conv_id, t, (xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                lambda c, x: xor(c >> 8, step[xor(c & 255, x) + 1])), 4294967295) % 6)::BIGINT AS h FROM own, rule),
        again AS (SELECT a.conv_id, list_concat(coalesce(b.t, [])[:a.h], a.t[a.h + 1:]) AS t FROM numbered a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 100),
        places AS (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS depth FROM again),
        members AS (
            SELECT conv_id, depth, depth = len(t) AS ends, sha256(array_to_string(list_transform(t[:depth], lambda x: x.name), ',')) AS name,
                CASE WHEN depth > 0 THEN sha256(array_to_string(list_transform(t[:depth - 1], lambda x: x.name), ',')) END AS parent, CASE WHEN depth > 0 THEN t[depth].size ELSE 0 END AS size FROM places),
        nodes AS (
            SELECT depth, name, parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(size) AS saved,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM members GROUP BY depth, name, parent),
        below AS (SELECT depth - 1 AS depth, parent AS name, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY depth, parent),
        whole AS (SELECT n.*, coalesce(b.n, 0) AS n_children FROM nodes n LEFT JOIN below b ON b.depth = n.depth AND b.name = n.name),
        up AS (
            SELECT m.depth, m.name, sum(w.saved) AS saved_tokens, count(*) FILTER (w.n_children = 0) AS n_leaves
            FROM whole w JOIN members m ON m.conv_id = w.conv_id AND m.depth <= w.depth GROUP BY m.depth, m.name)
        SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, u.n_leaves, u.saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
        FROM whole w JOIN up u ON u.depth = w.depth AND u.name = w.name LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.name = w.parent""",
}
if ORACLE_SQL:
    ORACLES["pipeline"] = ORACLE_SQL
