"""The registered query of each operator: production parameters over the
whole tables, and the digest columns that the contracts name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@_query("op4_minhash_near_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .near_dedup import near_duplicates
    return near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


_OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
occ AS (SELECT DISTINCT p.doc_id, p.i, p.n, win.item_id FROM place p JOIN win ON p.n = win.n AND p.s = win.s),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM occ) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""


@_query("op1_decontamination", _OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .decontaminate import decontaminate
    out = decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


@_query("op8_cost_balanced_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack
    return pack(read_table(spark, sf_dir, "documents"), with_ids=False)


@_query("op5_warc_round_trip")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from playstream.session import scratch_path

    from .warc import read_archives, write_archives
    files = write_archives(read_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return read_archives(files, with_payload=False).drop("url")


@_query("op3_line_crf_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import held_out, learn, score_documents
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels"))
    return score_documents(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@_query("op6_crf_secret_scan")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .secrets import learn, scan
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = scan(docs, learn(docs))

    def told(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select("doc_id", count("assign"), count("access"), count("hex"), count("model"),
                      F.sha2(told(F.filter("found", lambda x: x["kind"] != "model")), 256).alias("base_sha256"), told(F.col("found")).alias("spans"))


@_query("op9_html_tree_model")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .html_text import extract, learn
    out = extract(read_table(spark, sf_dir, "pages"), learn())
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


_OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
u AS (SELECT vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE list_dot_product(e, e) > 0),
link AS (
  SELECT a.vec_id AS s, b.vec_id AS t FROM u a JOIN u b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach(s, t) AS (SELECT s, t FROM link UNION SELECT r.s, l.t FROM reach r JOIN link l ON r.t = l.s),
comp AS (SELECT s, min(t) AS low FROM reach GROUP BY s),
cnt AS (SELECT s, count(*) AS n FROM link GROUP BY s)
SELECT e.vec_id, CAST(coalesce(cnt.n, 0) AS BIGINT) AS n_links, least(e.vec_id, coalesce(low, e.vec_id)) AS component_id,
       e.vec_id = least(e.vec_id, coalesce(low, e.vec_id)) AS kept
FROM embeddings e LEFT JOIN cnt ON cnt.s = e.vec_id LEFT JOIN comp ON comp.s = e.vec_id
"""


@_query("op10_epsilon_grid_order", _OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .embedding_dedup import near_embeddings
    return near_embeddings(read_table(spark, sf_dir, "embeddings"))


@_query("op7_trie_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts
    return token_counts(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_tokens", "n_words")


@_query("op2_paragraph_minhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .paragraph_dedup import repeated_paragraphs
    return repeated_paragraphs(read_table(spark, sf_dir, "documents"))


_OP11_SQL = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS VARCHAR) AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS s
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
pos AS (
  SELECT a, b AS p, s FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5)
SELECT pos.a AS anchor_id, pos.p AS positive_id, CAST(row_number() OVER (PARTITION BY pos.a, pos.p ORDER BY n.s DESC, n.b) AS INTEGER) AS rank,
       n.b AS negative_id, pos.s AS positive_score, n.s AS negative_score
FROM pos JOIN pairs n ON n.a = pos.a AND NOT n.same AND 50 * pos.s <= 100 * n.s AND 100 * n.s <= 95 * pos.s
QUALIFY row_number() OVER (PARTITION BY pos.a, pos.p ORDER BY n.s DESC, n.b) <= 3
"""


@_query("op11_hard_negatives", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from .hard_negatives import hard_negatives
    vectors = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), F.col("vec_id") % 50 == 0)


_OP12_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
x AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', ''))
         + (length(text) - length(replace(text, '<s>', ''))) // 3 + (length(text) - length(replace(text, '</s>', ''))) // 4
         + (length(text) - length(replace(text, '[INST]', ''))) // 6 + (length(text) - length(replace(text, '[/INST]', ''))) // 7
         + (length(text) - length(replace(text, '[TURN:', ''))) // 6 + (length(text) - length(replace(text, '[/TURN]', ''))) // 7 AS size
  FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(size + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 5 ELSE 14 + length(role) END) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id
"""


@_query("op12_chat_format", _OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import conversation_digests
    own = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    return conversation_digests(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(more))


_OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (
  SELECT DISTINCT item_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')) AS t FROM benchmark WHERE item_id IS NOT NULL),
total AS (SELECT count(*) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d WHERE len(w) > 0),
tf AS (
  SELECT r, doc_id, t, n, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM d)
  WHERE t IN (SELECT t FROM b) GROUP BY ALL),
weight AS (
  SELECT t, CAST(floor(1000 * ln((2 * (SELECT n FROM total) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf GROUP BY t),
score AS (
  SELECT item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * tf.n * total.n) // total.l)))) AS BIGINT) AS score
  FROM b JOIN tf USING (t) JOIN weight USING (t), total WHERE doc_id IS NOT NULL GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM score WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""


@_query("op13_ranked_search", _OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ranked_search import ranked
    return ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
