"""Registered queries of the training-data operators and their DuckDB twins.

Each query reads its whole table and derives the digest columns from the
operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from pyspark.sql import Column
from pyspark.sql import functions as F

from adsieve.llm import bpe, language_id, quality
from adsieve.llm.chat import format_chats
from adsieve.llm.common import WS, crc_mod, prepare, table
from adsieve.llm.covertree import near_vectors
from adsieve.llm.exact_dedup import decide_copies
from adsieve.llm.jaccard_join import jaccard_links
from adsieve.llm.kmeans_tree import nearest
from adsieve.llm.packing import pack
from adsieve.llm.resample import scores as resampling_scores
from adsieve.llm.substring_dedup import dedup_substrings
from adsieve.llm.warc import read_archives, write_archives
from adsieve.llm.whitening import whitened

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide_copies(table(prepare(spark), sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    words = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), WS + "+", " "))
    return dedup_substrings(docs).select("doc_id", "n_words", "n_removed", _sha(words).alias("kept_sha256"))


def op3_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe.encode(docs, path).select("doc_id", "ids")
    return bpe.decode(ids, path).select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), _sha(F.array_join("ids", " ")).alias("ids_sha256"),
        _sha(F.col("decoded")).alias("decoded_sha256"))


def op4_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(table(prepare(spark), sf_dir, "pages"))
    return read_archives(manifest, payloads=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(prepare(spark), sf_dir, "conversations"))


def op6_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train(docs, labels.where(crc_mod("doc_id", 3) != 1))
    return quality.score(docs, model).select(
        "row.doc_id", (crc_mod("row.doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(prepare(spark), sf_dir, "embeddings").select("vec_id", "embedding"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(prepare(spark), sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_links(table(prepare(spark), sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(prepare(spark), sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language_id.learn(docs.where(crc_mod("doc_id", 4) != 2))
    return language_id.classify(docs, profiles).select(
        "doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = resampling_scores(table(prepare(spark), sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return told.select("doc_id", "n_features", "weight", "score", "rank")


def op12_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(prepare(spark), sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitened(table(prepare(spark), sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def _sha(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
win AS (
  SELECT doc_id, p, array_to_string(list_slice(ws, p, p + 19), ' ') AS k
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS p FROM d)),
rep AS (
  SELECT doc_id, p
  FROM (SELECT doc_id, p, row_number() OVER (PARTITION BY k ORDER BY doc_id, p) AS rn FROM win) WHERE rn > 1),
gone AS (SELECT DISTINCT doc_id, p + o AS pos FROM rep, range(0, 20) AS r(o)),
word AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS pos FROM d),
kept AS (
  SELECT doc_id, string_agg(w, ' ' ORDER BY pos) AS t, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
sh AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, p, p + 4), ' ') AS s
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS p FROM d WHERE len(ws) > 0)),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT u, v FROM common JOIN sz x ON x.doc_id = u JOIN sz y ON y.doc_id = v WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
reach(id, r) AS (
  SELECT doc_id, doc_id FROM d
  UNION SELECT id, v FROM reach JOIN links ON u = r),
comp AS (SELECT id AS doc_id, min(r) AS component_id FROM reach GROUP BY id)
SELECT doc_id, (SELECT count(*) FROM links WHERE u = comp.doc_id) AS n_links, component_id, doc_id = component_id AS kept
FROM comp
"""

OP4_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS kept FROM p)
SELECT page_id, octet_length(encode(payload))::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(h, (i // 4)::INT * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> kept THEN kept END AS refers_to
FROM k
"""

OP5_SQL = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns, count(*) AS n_turns FROM t GROUP BY conv_id),
u AS (SELECT turns, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM c GROUP BY turns, n_turns),
begun AS (SELECT DISTINCT list_slice(turns, 1, k) AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM u))
SELECT t.conv_id, (pos - 1) // 1024 AS part, any_value(n_turns) AS n_turns, any_value(n_copies) AS n_copies,
       string_agg('<|im_start|>' || replace(role, '<|', '<\|') || chr(10) || replace(text, '<|', '<\|') || '<|im_end|>' || chr(10), '' ORDER BY pos) AS text
FROM u ANTI JOIN begun USING (turns) JOIN t ON t.conv_id = u.conv_id
GROUP BY t.conv_id, (pos - 1) // 1024
"""

OP7_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0, false) AS ok
  FROM embeddings),
u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS e FROM v WHERE ok),
links AS (
  SELECT a.vec_id AS u, b.vec_id AS v
  FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_dot_product(a.e, b.e) >= 0.95),
reach(id, r) AS (
  SELECT vec_id, vec_id FROM v
  UNION SELECT id, links.v FROM reach JOIN links ON links.u = r),
comp AS (SELECT id AS vec_id, min(r) AS component_id FROM reach GROUP BY id)
SELECT vec_id, (SELECT count(*) FROM links WHERE u = comp.vec_id) AS n_links, component_id, vec_id = component_id AS kept
FROM comp
"""

OP11_SQL = r"""
WITH RECURSIVE bits(i, c, k) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS step FROM bits WHERE k = 8),
d AS (
  SELECT doc_id, 0 AS side, text FROM documents
  UNION ALL SELECT NULL, 1, text FROM benchmark),
w AS (
  SELECT doc_id, side, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM d),
f AS (
  SELECT doc_id, side, array_to_string(ws[p:p + k], ' ') AS f
  FROM (SELECT doc_id, side, ws, unnest(range(1, len(ws) + 1)) AS p FROM w), range(0, 3) AS r(k) WHERE p + k <= len(ws)),
g AS (SELECT f, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM f GROUP BY f),
h AS (SELECT f, s, t, hex(encode(f)) AS x FROM g),
b AS (
  SELECT f, s, t, xor(list_reduce(list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT),
      lambda c, y: xor(c >> 8, step[(xor(c, y) & 255) + 1]), 4294967295), 4294967295) % 10000 AS bucket
  FROM h, crc),
total AS (SELECT bucket, sum(s) AS s, sum(t) AS t FROM b GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS g
  FROM total),
weigh AS (SELECT doc_id, sum(g)::BIGINT AS weight FROM f JOIN b USING (f) JOIN gain USING (bucket) WHERE side = 0 GROUP BY doc_id),
score AS (
  SELECT doc_id, len(ws) AS n, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM w LEFT JOIN weigh USING (doc_id) WHERE side = 0),
drawn AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS total FROM score WHERE n >= 20)
SELECT doc_id, (n + greatest(n - 1, 0) + greatest(n - 2, 0))::BIGINT AS n_features, weight, score,
       CASE WHEN rank <= 5 * total // 100 THEN rank END AS rank
FROM score LEFT JOIN drawn USING (doc_id)
"""

QUERIES: dict[str, Query] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_bpe_tree": op3_bpe_tree,
    "op4_warc_zip": op4_warc_zip,
    "op5_chat_format": op5_chat_format,
    "op6_quality_mil": op6_quality_mil,
    "op7_cover_tree": op7_cover_tree,
    "op8_packing": op8_packing,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_language_id": op10_language_id,
    "op11_resampling": op11_resampling,
    "op12_nearest": op12_nearest,
    "op13_whitening": op13_whitening,
}

ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op2_substring_dedup": OP2_SQL,
    "op4_warc_zip": OP4_SQL,
    "op5_chat_format": OP5_SQL,
    "op7_cover_tree": OP7_SQL,
    "op9_jaccard_join": OP9_SQL,
    "op11_resampling": OP11_SQL,
}
