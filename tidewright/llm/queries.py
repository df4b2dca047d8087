"""The registered queries opN_<name>: thin callers of the operators, with production parameters, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import bpe_decode, bpe_encode
from .embed_dedup import near_duplicates
from .langid import language_id
from .mixing import WINDOW, pareto_mix
from .ngram_join import ngram_jaccard_join
from .pii import replace_pii
from .quality import quality
from .shards import read_slots, write_shards
from .substring import substring_dedup
from .topk import top_k

#: The key of surrogates in queries and the pipeline; a deployment sets its own.
PII_KEY = "tidewright"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"""
d AS (
  SELECT doc_id, regexp_extract_all({text}, '[^\x20\x09-\x0D]+') AS w FROM documents
), x AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d
)"""


def _window(k: int) -> str:
    """The words of a window of k from a word on, null where the text ends before."""
    return f"CASE WHEN lead(word, {k - 1}) OVER o IS NOT NULL THEN concat_ws(' ', word, {', '.join(f'lead(word, {j}) OVER o' for j in range(1, k))}) END"


OP1_SQL = f"""
WITH RECURSIVE {_WORDS.format(text=f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')")}
, g AS (
  SELECT doc_id, {_window(5)} AS s FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), s AS (
  SELECT DISTINCT doc_id, s FROM g WHERE s IS NOT NULL UNION SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM shared JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)
), reached AS (
  SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(least_, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT a, min(b) AS least_ FROM reached GROUP BY a) r ON r.a = d.doc_id
"""


def op2_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(_table(spark, sf_dir, "documents"), key=PII_KEY).select("doc_id", "n_entities", "text")


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op5_pareto_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


OP5_SQL = rf"""
WITH RECURSIVE x AS (
  SELECT *, coalesce(md5(text), repeat('0', 32)) AS digest, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
), d AS (
  SELECT doc_id, source, size, length(bin(size)) AS w, CAST('0x' || substr(digest, 1, 15) AS BIGINT) AS hash,
    (CAST(('0x' || substr(md5('mix' || chr(1) || coalesce(CAST(doc_id AS VARCHAR), '-') || chr(1) || digest), 1, 13)) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4503599627370496 AS DOUBLE) AS u FROM x
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS sid FROM d GROUP BY source
), sw AS (
  SELECT *, CAST((sid - 1) % 3 + 1 AS DOUBLE) AS weight, source_size * CAST(3 AS DOUBLE) AS most FROM s
), l AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER (ORDER BY most / weight, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, sid ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM sw
), t AS (
  SELECT sid, source, source_size, least(most, weight * coalesce((SELECT level FROM l WHERE level <= most / weight ORDER BY most / weight, sid LIMIT 1), 0)) AS target FROM sw
), c AS (
  SELECT t.sid, target, w, sum(size) AS words FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source GROUP BY t.sid, target, w
), cl AS (
  SELECT *, (target - 3 * coalesce(sum(words) OVER (PARTITION BY sid ORDER BY w DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / nullif(sum(words * w) OVER (PARTITION BY sid ORDER BY w DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS level FROM c
), lv AS (
  SELECT sid, coalesce(arg_max(level, w) FILTER (level * w <= 3), CASE WHEN any_value(target) > 0 THEN 3.0 ELSE 0.0 END) AS level FROM cl GROUP BY sid
), e AS (
  SELECT d.*, t.sid, source_size, target, least(CAST(3 AS DOUBLE), level * w) AS expected FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source JOIN lv ON lv.sid = t.sid
), q AS (
  SELECT *, CAST(floor(expected) AS BIGINT) AS whole,
    CASE WHEN expected - floor(expected) > 0 THEN (u / (1 - u)) * ((1 - (expected - floor(expected))) / (expected - floor(expected))) END AS q FROM e
), r AS (
  SELECT sid, any_value(target) - sum(whole * size) AS rest FROM q GROUP BY sid
), g AS (
  SELECT sid, q, doc_id, size, hash, count(*) AS many FROM q WHERE q IS NOT NULL GROUP BY ALL
), n AS (
  SELECT g.*, rest, row_number() OVER o AS n, sum(many * size) OVER o AS upto, sum(many) OVER o - many AS place FROM g JOIN r USING (sid)
  WINDOW o AS (PARTITION BY g.sid ORDER BY q, doc_id NULLS FIRST, size, hash ROWS UNBOUNDED PRECEDING)
), stop AS (
  SELECT sid, min(n) AS stop, min(place) AS stop_place FROM n WHERE upto > rest GROUP BY sid
), win AS (
  SELECT n.* FROM n JOIN stop USING (sid) WHERE n.n >= stop AND place < stop_place + {WINDOW}
), f AS (
  SELECT w.sid, n, many, size, rest - (upto - many * size) AS gap, CASE WHEN size > 0 THEN least(many, greatest(0, CAST(floor((rest - (upto - many * size)) / size) AS BIGINT))) ELSE many END AS k
  FROM win w JOIN stop USING (sid) WHERE n = stop
  UNION ALL
  SELECT w.sid, w.n, w.many, w.size, f.gap - f.k * f.size, CASE WHEN w.size > 0 THEN least(w.many, greatest(0, CAST(floor((f.gap - f.k * f.size) / w.size) AS BIGINT))) ELSE w.many END
  FROM f JOIN win w ON w.sid = f.sid AND w.n = f.n + 1
), ended AS (
  SELECT sid, arg_max(gap - k * size, n) AS gap FROM f GROUP BY sid
), best AS (
  SELECT f.sid, arg_min(n, struct_pack(d := abs(ended.gap - size), n := n)) AS best FROM f JOIN ended USING (sid) WHERE k < many AND abs(ended.gap - size) < ended.gap GROUP BY f.sid
), k AS (
  SELECT f.sid, n, k + CASE WHEN n IS NOT DISTINCT FROM best THEN 1 ELSE 0 END AS k FROM f LEFT JOIN best USING (sid)
), docs AS (
  SELECT q.*, n.n, stop, k, row_number() OVER (PARTITION BY q.sid, q.q, q.doc_id, q.size, q.hash) AS copy
  FROM q LEFT JOIN n ON n.sid = q.sid AND n.q = q.q AND n.doc_id IS NOT DISTINCT FROM q.doc_id AND n.size = q.size AND n.hash = q.hash LEFT JOIN stop ON stop.sid = q.sid LEFT JOIN k ON k.sid = q.sid AND k.n = n.n
), taken AS (
  SELECT *, whole + CASE WHEN q IS NULL THEN 0 WHEN stop IS NULL OR n < stop THEN 1 WHEN copy <= coalesce(k, 0) THEN 1 ELSE 0 END AS copies FROM docs
)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target, CAST(copies * size AS BIGINT) AS taken, CAST(copies AS BIGINT) AS copies FROM taken
"""


def op6_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    out = bpe_decode(bpe_encode(_table(spark, sf_dir, "documents"), vocabulary), vocabulary)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_binary_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards, index = write_shards(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), key="tidewright")
    found = read_slots(shards).select("slot", "shard", "offset", F.sha2("ids", 256).alias("ids_sha256"))
    return index.join(found, "slot").select("slot", "shard", "offset", "doc_id", "seq", "n_tokens", "ids_sha256")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "embeddings"))


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), u AS (
  SELECT vec_id, list_transform(v, lambda x: x / sqrt(list_inner_product(v, v))) AS u FROM v
  WHERE v IS NOT NULL AND len(v) > 0 AND list_bool_and(list_transform(v, lambda x: x IS NOT NULL AND isfinite(x))) AND list_inner_product(v, v) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND len(a.u) = len(b.u) AND list_inner_product(a.u, b.u) >= 0.95
), reached AS (
  SELECT a, b FROM links UNION SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
), found AS (
  SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(least_, v.vec_id)) AS component_id FROM v
  LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = v.vec_id LEFT JOIN (SELECT a, min(b) AS least_ FROM reached GROUP BY a) r ON r.a = v.vec_id
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM found
"""


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), "n_factors")


OP9_SQL = f"""
WITH {_WORDS.format(text="coalesce(text, '')")}
, k AS (
  SELECT doc_id, i, word, {_window(13)} AS k FROM x WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), f AS (
  SELECT k, min(struct_pack(doc := doc_id, place := i)) AS f FROM k WHERE k IS NOT NULL GROUP BY k
), h AS (
  SELECT k.*, CASE WHEN f.f.doc < doc_id THEN f.f.doc END AS source, CASE WHEN f.f.doc < doc_id THEN f.f.place END AS place FROM k LEFT JOIN f ON f.k = k.k
), c AS (
  SELECT *, coalesce(max(CASE WHEN source IS NOT NULL THEN i END) OVER o >= i - 12, false) AS gone,
    source IS NOT NULL AND NOT coalesce(lag(source) OVER o = source AND lag(place) OVER o = place - 1, false) AS begins
  FROM h WINDOW o AS (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING)
), t AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept, count(*) FILTER (begins) AS n_factors FROM c GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, coalesce(n_factors, 0) AS n_factors FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_ngram_jaccard_join, op2_pii_surrogates, op3_exact_top_k, op4_language_id, op5_pareto_mixing, op6_byte_level_bpe, op7_binary_shards, op8_embedding_near_dedup, op9_substring_dedup, op10_quality_classifier)
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {"op1_ngram_jaccard_join": OP1_SQL, "op3_exact_top_k": OP3_SQL, "op5_pareto_mixing": OP5_SQL, "op8_embedding_near_dedup": OP8_SQL, "op9_substring_dedup": OP9_SQL}
