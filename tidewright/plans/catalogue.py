"""The queries over the driver's tables and their SQL.

The tables hold no audio and no Danish, so they map operators, not datasets:
documents stand for transcripts, labels for metadata, benchmark for evaluation
sentences, conversations for captions in order, embeddings for waveforms.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays, scalars, text
from ..functions.numerals import TENS, UNITS, numerals_to_words
from ..operators import filters, joins, metrics, mix, ngrams, scoring, validation, vtt
from ..sources import manifest, shards
from ..store import numbered, scratch, spread

KEEP = "abcdefghijklmnopqrstuvwxyzæøåéü0123456789"
#: Weights of languages in the interleaving; others have 1.
LANGUAGES = {"en": 5, "fr": 3, "de": 2}
_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def add(f: Callable) -> Callable:
        _QUERIES[f.__name__] = f
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _texts(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    """Documents, for work that costs more than to read them."""
    return spread(_t(spark, sf, "documents").select(*columns))


# --- filters, limits, sets -------------------------------------------------


@_query("SELECT doc_id, source, lang FROM documents WHERE source = 'src1' AND lang = 'en'")
def row_filters(spark, sf):
    return filters.row_filters(_t(spark, sf, "documents"), {"source": "src1", "lang": "en"}).select("doc_id", "source", "lang")


@_query("SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS samples FROM documents WHERE len(string_split(text, ' ')) > 80 AND len(string_split(text, ' ')) < 960 AND regexp_matches(text, '\\S')")
def nonempty_duration(spark, sf):
    d = _t(spark, sf, "documents").withColumn("a", F.split("text", " "))
    return filters.examples(d, "a", 16, "text", 5, 60).select("doc_id", F.size("a").alias("samples"))


@_query("SELECT doc_id, toxic FROM labels WHERE toxic IS NULL OR toxic <> 1")
def validation_flag(spark, sf):
    d = _t(spark, sf, "labels").withColumn("validated", F.when(F.col("toxic") == 1, "rejected"))
    return filters.not_rejected(d).select("doc_id", "toxic")


@_query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey % 8 BETWEEN 2 AND 4 AND o_totalprice > 1000 AND o_totalprice < 200000")
def shard_scan(spark, sf):
    """Orders written as eight shards, of which a pinned range is read."""
    folder = scratch(spark, "shards")
    shard = F.format_string("%05d", F.col("o_orderkey") % 8)
    _t(spark, sf, "orders").select("o_orderkey", "o_totalprice", shard.alias("shard")).write.partitionBy("shard").parquet(folder)
    picked = {"template": "shard={shard:05d}", "start": 2, "end": 4}
    return shards.read_shards(spark, folder, picked, [f"shard={i:05d}" for i in range(8)], "0" * 40).where("o_totalprice > 1000 AND o_totalprice < 200000").select("o_orderkey", "o_totalprice")


@_query("""
WITH n AS (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events)
SELECT event_id, value FROM n WHERE value > 1 AND value < 30 AND place % 3 IN (0, 2)
""")
def manifest_duration(spark, sf):
    """Events written as a manifest in the order of their ids, of which two shards of three are read."""
    path = scratch(spark, "manifest")
    e = _t(spark, sf, "events")
    rows = e.select(F.lit("events").alias("source_wav_path"), F.lit(0.0).alias("start"), F.col("value").alias("end"), F.col("value").alias("duration"), F.lit("").alias("text"), F.col("event_id").cast("string").alias("id"), F.lit("en").alias("language"), "event_id")
    manifest.write_manifest(rows.orderBy("event_id").drop("event_id"), path)
    found = manifest.read_manifest(spark, path, 1, 30, [0, 2], 3)
    return found.select(F.col("id").cast("long").alias("event_id"), F.col("duration").alias("value"))


@_query("SELECT count(*) - count(CASE WHEN toxic <> 1 THEN 1 END) AS removed FROM labels")
def removed_rows(spark, sf):
    d = _t(spark, sf, "labels")
    return filters.removed(d, d.where("toxic <> 1"))


@_query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 100")
def take_n(spark, sf):
    return mix.take(_t(spark, sf, "orders").select("o_orderkey", "o_custkey"), 100, ["o_orderkey"])


@_query("SELECT DISTINCT md5(text) AS text_md5 FROM documents")
def dedupe_sentences(spark, sf):
    return ngrams.distinct_sentences(_t(spark, sf, "documents"), "text").select(F.md5("text").alias("text_md5"))


@_query("SELECT md5(text) AS text_md5, 'en' AS language FROM documents UNION ALL SELECT md5(text), '' FROM conversations")
def standardise_union(spark, sf):
    both = mix.concatenate([mix.standardise(_t(spark, sf, "documents"), "en"), mix.standardise(_t(spark, sf, "conversations"))])
    return both.select(F.md5("text").alias("text_md5"), "language")


@_query("SELECT DISTINCT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def missing_members(spark, sf):
    orders = _t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return joins.missing_members(_t(spark, sf, "customer"), orders, "c_custkey")


# --- joins -----------------------------------------------------------------


@_query("SELECT l.doc_id, quality, toxic, md5(text) AS text_md5 FROM labels l JOIN documents d ON l.doc_id = d.doc_id WHERE regexp_matches(text, '\\S')")
def transcript_join(spark, sf):
    out = joins.transcript_join(_t(spark, sf, "labels"), _t(spark, sf, "documents"), "doc_id", "doc_id", "text")
    return out.select("doc_id", "quality", "toxic", F.md5("text").alias("text_md5"))


@_query("SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'")
def lookup(spark, sf):
    nation, region = _t(spark, sf, "nation"), _t(spark, sf, "region").where("r_name <> 'ASIA'")
    out = joins.lookup(_t(spark, sf, "customer"), nation, "c_nationkey", "n_nationkey", "n_name", "n_name")
    out = joins.lookup(out, nation, "c_nationkey", "n_nationkey", "n_regionkey", "region_key")
    return joins.lookup(out, region, "region_key", "r_regionkey", "r_name", "r_name").select("c_custkey", "n_name", "r_name")


@_query("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text) AND b.text <> ''")
def contained_benchmark(spark, sf):
    b = _t(spark, sf, "benchmark").select("item_id", F.col("text").alias("phrase"))
    return joins.contains_join(_texts(spark, sf, "doc_id", "text"), b, "text", "phrase").select("doc_id", "item_id")


@_query("""
WITH m AS (
  SELECT doc_id, array_agg(phrase ORDER BY length(phrase) DESC, phrase) AS p
  FROM documents d JOIN (SELECT DISTINCT text AS phrase FROM benchmark WHERE text <> '') b ON contains(d.text, b.phrase) GROUP BY doc_id
), r AS (
  SELECT d.doc_id, CASE WHEN p IS NULL THEN text ELSE trim(regexp_replace(list_reduce(list_prepend(text, p), lambda a, b: replace(a, b, '')), ' +', ' ', 'g')) END AS text, p IS NOT NULL AS changed
  FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id
)
SELECT doc_id, md5(text) AS text_md5, changed FROM r WHERE text <> ''
""")
def decontaminate(spark, sf):
    out = ngrams.decontaminate(_texts(spark, sf, "doc_id", "text"), _t(spark, sf, "benchmark"), "doc_id", "text", "text")
    return out.select("doc_id", F.md5("text").alias("text_md5"), "changed")


# --- text ------------------------------------------------------------------

_FILLER = r"(^|[^\p{L}\p{N}_])(eh+m*|øh+m*|h+m+|m+h+)($|[^\p{L}\p{N}_])"


def _sql_fillers(x: str) -> str:
    # each match eats a separator, so neighbours need a second pass
    for _ in range(2):
        x = f"regexp_replace({x}, '{_FILLER}', '\\1\\3', 'gi')"
    return x


def _sql_replacements(x: str) -> str:
    for a, b in text.REPLACEMENTS.items():
        x = f"replace({x}, '{a}', '{b}')"
    return x


def _sql_lines(x: str) -> str:
    lines = f"list_transform(string_split({x}, chr(10)), lambda l: regexp_replace(l, '^\\s+|\\s+$', '', 'g'))"
    return f"regexp_replace(array_to_string({lines}, chr(10)), '^\\n+|\\n+$', '', 'g')"


_CLEAN = _sql_replacements(_sql_fillers("lower(text)"))
_KEPT = f"regexp_replace(regexp_replace({_CLEAN}, '^\\s+|\\s+$', '', 'g'), '(?i)[^{KEEP} |]', ' ', 'g')"


@_query(f"SELECT doc_id, md5({_sql_lines(f'''regexp_replace({_CLEAN}, ' +', ' ', 'g')''')}) AS clean_md5 FROM documents")
def clean_text(spark, sf):
    return _texts(spark, sf, "doc_id", "text").select("doc_id", F.md5(text.clean_transcript(F.col("text"))).alias("clean_md5"))


@_query(f"SELECT doc_id, md5({_sql_lines(f'''regexp_replace({_KEPT}, ' +', ' ', 'g')''')}) AS clean_md5 FROM documents")
def clean_text_keep(spark, sf):
    return _texts(spark, sf, "doc_id", "text").select("doc_id", F.md5(text.clean_transcript(F.col("text"), keep=KEEP)).alias("clean_md5"))


@_query(f"SELECT doc_id, md5({_sql_fillers('lower(text)')}) AS clean_md5 FROM documents")
def clean_filler(spark, sf):
    return _texts(spark, sf, "doc_id", "text").select("doc_id", F.md5(text.remove_fillers(F.lower("text"))).alias("clean_md5"))


@_query(f"""
WITH c AS (SELECT lang, {_sql_lines(f'''regexp_replace({_KEPT}, ' +', ' ', 'g')''')} AS t FROM documents)
SELECT lang, count(*) AS n, CAST(sum(length(t)) AS BIGINT) AS chars FROM c WHERE t <> '' GROUP BY lang
""")
def clean_by_language(spark, sf):
    clean = _texts(spark, sf, "lang", "text").select("lang", text.clean_transcript(F.col("text"), keep=KEEP).alias("t"))
    return clean.where(filters.has_text(F.col("t"))).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("t")).alias("chars"))


def _sql_number(n: str) -> str:
    """The words of a whole number below 1000, from the tables of words."""
    units = "[" + ", ".join(f"'{x}'" for x in UNITS) + "]"
    tens = "[" + ", ".join(f"'{TENS.get(i, '')}'" for i in range(10)) + "]"
    small = lambda m: f"CASE WHEN {m} < 20 THEN {units}[{m} + 1] WHEN {m} % 10 = 0 THEN {tens}[{m} // 10 + 1] ELSE {units}[{m} % 10 + 1] || 'og' || {tens}[{m} // 10 + 1] END"
    hundreds = f"(CASE WHEN {n} // 100 = 1 THEN 'et' ELSE {units}[{n} // 100 + 1] END || ' hundrede')"
    return f"CASE WHEN {n} = 100 THEN 'hundrede' WHEN {n} < 100 THEN {small(n)} WHEN {n} % 100 = 0 THEN {hundreds} ELSE {hundreds} || ' og ' || {small(f'({n} % 100)')} END"


@_query(f"SELECT p_partkey, 'vare ' || {_sql_number('(p_partkey % 1000)')} || ' har ' || {_sql_number('p_size')} || ' dele' AS spelled FROM part")
def numerals(spark, sf):
    said = F.concat(F.lit("vare "), (F.col("p_partkey") % 1000).cast("string"), F.lit(" har "), F.col("p_size").cast("string"), F.lit(" dele"))
    return _t(spark, sf, "part").select("p_partkey", numerals_to_words(said).alias("spelled"))


@_query(r"""
WITH p AS (
  SELECT page_id, url, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
    regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*://', ''), '[?#].*$', '') AS rest FROM pages
), h AS (
  SELECT *, regexp_replace(regexp_extract(rest, '^([^/]*)', 1), '^.*@', '') AS host, regexp_extract(rest, '^[^/]*(.*)$', 1) AS path FROM p
)
SELECT page_id, CASE WHEN url IS NULL THEN NULL WHEN scheme = '' OR host = '' THEN '<invalid URL>' ELSE scheme || '://' || host || path END AS url FROM h
""")
def sanitise_url(spark, sf):
    return _t(spark, sf, "pages").select("page_id", text.sanitise_url(F.col("url")).alias("url"))


@_query("SELECT DISTINCT source, replace(lower('val_' || source || '_' || lang), '-', '_') AS name FROM documents")
def split_names(spark, sf):
    return _t(spark, sf, "documents").select("source", text.split_name(F.concat(F.lit("corpus/"), "source"), F.col("lang")).alias("name")).distinct()


@_query(r"""
WITH w AS (SELECT list_filter(string_split(text, ' '), lambda x: x <> '') AS w FROM documents),
g AS (
  SELECT n, unnest(list_transform(range(1, CAST(len(w) - n + 2 AS BIGINT)), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS ngram
  FROM w, (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n
)
SELECT CAST(n AS INTEGER) AS n, ngram, count(*) AS count FROM g GROUP BY n, ngram HAVING count(*) > CASE WHEN n = 1 THEN 0 ELSE 1 END
""")
def ngram_counts(spark, sf):
    return ngrams.ngram_counts(_texts(spark, sf, "text"), "text", 3)


@_query("""
WITH c AS (SELECT DISTINCT unnest(string_split(text, '')) AS char FROM documents UNION SELECT '|')
SELECT char, row_number() OVER (ORDER BY char) - 1 AS id FROM c WHERE char <> ''
""")
def vocabulary(spark, sf):
    return ngrams.vocabulary(_texts(spark, sf, "text"), "text")


# --- captions --------------------------------------------------------------


@_query(r"""
WITH c AS (
  SELECT conv_id, turn, text AS cur, coalesce(lag(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS prev FROM conversations
), w AS (
  SELECT *, list_filter(string_split(prev, ' '), lambda x: x <> '') AS a, list_filter(string_split(cur, ' '), lambda x: x <> '') AS b FROM c
), k AS (
  SELECT *, coalesce(list_max(list_filter(range(1, least(len(a), len(b)) + 1), lambda n: a[len(a) - n + 1:] = b[:n])), 0) AS k FROM w
)
SELECT conv_id, turn, md5(CASE WHEN prev = '' THEN cur WHEN prev = cur THEN '' WHEN starts_with(cur, prev) THEN regexp_replace(substr(cur, length(prev) + 1), '^\s+|\s+$', '', 'g')
  WHEN k = 0 THEN cur ELSE array_to_string(b[k + 1:], ' ') END) AS rest_md5 FROM k
""")
def rolling_overlap(spark, sf):
    before = F.coalesce(F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")), F.lit(""))
    return _t(spark, sf, "conversations").select("conv_id", "turn", F.md5(vtt.remove_overlap(before, F.col("text"))).alias("rest_md5"))


@_query("SELECT event_id, substr(sha256(event_type || chr(0) || printf('%.3f', value) || chr(0) || printf('%.3f', value + 1.5) || chr(0) || props), 1, 24) AS id FROM events")
def cue_ids(spark, sf):
    return _t(spark, sf, "events").select("event_id", scalars.cue_id(F.col("event_type"), F.col("value"), F.col("value") + 1.5, F.col("props")).alias("id"))


@_query(r"""
WITH c AS (
  SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS block, trim(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '<[^>]*>', ' ', 'g')) AS cur FROM conversations
), p AS (
  SELECT *, coalesce(lag(cur) OVER (PARTITION BY conv_id ORDER BY turn), '') AS prev FROM c
), w AS (
  SELECT *, list_filter(string_split(prev, ' '), lambda x: x <> '') AS a, list_filter(string_split(cur, ' '), lambda x: x <> '') AS b FROM p
), k AS (
  SELECT *, coalesce(list_max(list_filter(range(1, least(len(a), len(b)) + 1), lambda n: a[len(a) - n + 1:] = b[:n])), 0) AS k FROM w
), t AS (
  SELECT *, CASE WHEN prev = '' THEN cur WHEN prev = cur THEN '' WHEN starts_with(cur, prev) THEN trim(substr(cur, length(prev) + 1)) WHEN k = 0 THEN cur ELSE array_to_string(b[k + 1:], ' ') END AS text FROM k
)
SELECT conv_id, CAST(block AS INTEGER) AS block, CAST(turn AS DOUBLE) AS start, turn + CAST(0.5 AS DOUBLE) AS "end", md5(text) AS text_md5, CASE WHEN text = '' THEN 'empty' ELSE 'ok' END AS status FROM t
""")
def caption_parse(spark, sf):
    """Conversations written as WebVTT files, and parsed again."""
    clock = F.format_string("%02d:%02d:%02d.000", F.floor(F.col("turn") / 3600), F.floor(F.col("turn") / 60) % 60, F.col("turn") % 60)
    after = F.format_string("%02d:%02d:%02d.500", F.floor(F.col("turn") / 3600), F.floor(F.col("turn") / 60) % 60, F.col("turn") % 60)
    cue = F.concat(clock, F.lit(" --> "), after, F.lit(" align:start\n<c>"), F.regexp_replace("text", r"\s+", " "), F.lit("</c>"))
    files = _t(spark, sf, "conversations").groupBy("conv_id").agg(F.concat(F.lit("WEBVTT\n\n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("turn", cue.alias("cue")))), lambda x: x["cue"]), "\n\n")).alias("content"))
    out = vtt.cues(files.withColumn("path", F.col("conv_id").cast("string")))
    return out.select(F.col("path").cast("long").alias("conv_id"), "block", "start", "end", F.md5("text").alias("text_md5"), "status")


# --- speakers and scores ---------------------------------------------------

_AGE = "CASE WHEN age < 25 THEN '0-25' WHEN age < 50 THEN '25-50' ELSE '50+' END"


@_query(f"""
WITH c AS (
  SELECT c_custkey, c_custkey % 90 AS age, CASE c_nationkey % 4 WHEN 0 THEN 'fynsk' WHEN 1 THEN 'lollandsk' WHEN 2 THEN 'østjysk' END AS sub,
    CASE WHEN c_nationkey % 5 = 0 THEN 'SE' WHEN c_nationkey % 5 < 3 THEN 'DK' END AS born FROM customer
)
SELECT c_custkey, {_AGE} AS age_group, CASE WHEN coalesce(born, 'DK') <> 'DK' THEN 'Non-native' WHEN sub = 'fynsk' THEN 'Fynsk' WHEN sub = 'lollandsk' THEN 'Sydømål' WHEN sub = 'østjysk' THEN 'Østjysk' END AS dialect FROM c
""")
def age_dialect(spark, sf):
    c, n = _t(spark, sf, "customer"), F.col("c_nationkey")
    sub = F.when(n % 4 == 0, "fynsk").when(n % 4 == 1, "lollandsk").when(n % 4 == 2, "østjysk")
    born = F.when(n % 5 == 0, "SE").when(n % 5 < 3, "DK")
    return c.select("c_custkey", scalars.age_group(F.col("c_custkey") % 90).alias("age_group"), scalars.dialect(sub, born).alias("dialect"))


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled English documents, whole, as transcripts, with a prediction that drops and changes letters."""
    d = _t(spark, sf, "documents").where("lang = 'en'").join(_t(spark, sf, "labels"), "doc_id")
    ref = F.regexp_replace(F.lower("text"), "[^a-z ]", " ")
    hyp = F.regexp_replace(F.regexp_replace(ref, "th", "t"), "e[rn] ", "es ")
    return d.select("doc_id", F.concat(F.lit("age"), (F.col("doc_id") % 3).cast("string")).alias("age_group"), F.when(F.col("doc_id") % 7 > 0, F.when(F.col("doc_id") % 2 == 0, "female").otherwise("male")).alias("gender"), F.col("source").alias("dialect"), ref.alias("text"), hyp.alias("prediction"))


def _named(spark: SparkSession, sf: str, *changes: tuple[str, str]) -> DataFrame:
    """Names of parts as transcripts, with a prediction in which patterns are replaced."""
    p, hyp = _t(spark, sf, "part"), F.col("p_name")
    for pattern, new in changes:
        hyp = F.regexp_replace(hyp, pattern, new)
    return p.select(F.concat(F.lit("age"), (F.col("p_size") % 3).cast("string")).alias("age_group"), F.when(F.col("p_partkey") % 7 > 0, F.when(F.col("p_partkey") % 2 == 0, "female").otherwise("male")).alias("gender"), F.col("p_type").alias("dialect"), F.col("p_name").alias("text"), hyp.alias("prediction"))


def _cube_sql(hyp: str, measures: dict[str, str], rates: str) -> str:
    """The pruned cube over names of parts; measures of ref and hyp are summed, rates made of the sums."""
    cats, bits = ["age_group", "gender", "dialect"], [4, 2, 1]
    keep, joined = [], ""
    for i in range(3):
        for what, upto in (("b", i), ("a", i + 1)):
            # the prefix has "any" from there on
            mask = sum(bits[upto:])
            on = " AND ".join([f"{what}{i}.gid = (c.gid | {mask})", *[f"{what}{i}.{x} IS NOT DISTINCT FROM c.{x}" for x in cats[:upto]]])
            joined += f" LEFT JOIN cube {what}{i} ON ({what}{i}.gid & {mask}) = {mask} AND {on}"
        keep.append(f"((c.gid & {bits[i]}) <> 0 OR (a{i}.n > 0 AND a{i}.n < b{i}.n))")
    some = " AND ".join(f"((gid & {b}) <> 0 OR {x} IS NOT NULL)" for x, b in zip(cats, bits, strict=True))
    return f"""
WITH e AS (
  SELECT 'age' || (p_size % 3) AS age_group, CASE WHEN p_partkey % 7 > 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'female' ELSE 'male' END END AS gender, p_type AS dialect, trim(p_name) AS ref, trim({hyp}) AS hyp FROM part
), u AS (
  SELECT age_group, gender, dialect, {", ".join(f"{v} AS {k}" for k, v in measures.items())} FROM e
), g AS (
  SELECT age_group, gender, dialect, grouping_id(age_group, gender, dialect) AS gid, count(*) AS n, {", ".join(f"sum({k}) AS {k}" for k in measures)} FROM u GROUP BY CUBE (age_group, gender, dialect)
), cube AS (
  SELECT * FROM g WHERE {some}
)
SELECT c.age_group, c.gender, c.dialect, c.n, {rates} FROM cube c {joined} WHERE {" AND ".join(keep)}
"""


def _cer_cube(scored: DataFrame) -> DataFrame:
    rows = scored.withColumn("c", metrics.char_edits(F.col("text"), F.col("prediction")))
    cer = metrics.rate(*[F.sum(f"c.{x}") for x in "sdih"], normalise=False)
    return scoring.pruned_cube(rows, ["age_group", "gender", "dialect"], {"cer": cer})


_SQL_CER = {"lev": "levenshtein(ref, hyp)", "len": "length(ref)"}


@_query(_cube_sql("regexp_replace(regexp_replace(p_name, 'o', 'oe', 'g'), 'i[nr]g?', 'um', 'g')", _SQL_CER, "CASE WHEN c.len > 0 THEN CAST(c.lev AS DOUBLE) / c.len END AS cer"))
def score_cube(spark, sf):
    """Corpus character error rates of all parts' names, by combinations of age, gender and dialect."""
    return _cer_cube(_named(spark, sf, ("o", "oe"), ("i[nr]g?", "um")))


@_query()
def score_cube_whole(spark, sf):
    """The same of whole documents, which are too long for the SQL engine's distance."""
    return _cer_cube(_scored(spark, sf))


# where a prediction only lacks letters and words, all edits but those of changed words are deletions, so costs tell the operations
@_query(_cube_sql("regexp_replace(p_name, '[aeu]|^(red|blue) ', '', 'g')", _SQL_CER | {
    "wlev": "len(string_split(ref, ' ')) - len(string_split(hyp, ' ')) + CASE WHEN len(string_split(ref, ' ')) = len(string_split(hyp, ' ')) THEN (string_split(ref, ' ')[1] <> string_split(hyp, ' ')[1])::INT + (string_split(ref, ' ')[2] <> string_split(hyp, ' ')[2])::INT ELSE (string_split(ref, ' ')[2] <> string_split(hyp, ' ')[1])::INT END",
    "wlen": "len(string_split(ref, ' '))"}, "CAST(c.lev AS DOUBLE) / c.len AS cer, CAST(c.wlev AS DOUBLE) / c.wlen AS wer"))
def score_cube_normalised(spark, sf):
    rows = _named(spark, sf, ("[aeu]|^(red|blue) ", "")).withColumn("c", metrics.char_edits(F.col("text"), F.col("prediction"))).withColumn("w", metrics.word_edits(F.col("text"), F.col("prediction")))
    rates = {name: metrics.rate(*[F.sum(f"{e}.{x}") for x in "sdih"]) for name, e in (("cer", "c"), ("wer", "w"))}
    return scoring.pruned_cube(rows, ["age_group", "gender", "dialect"], rates)


@_query(r"""
WITH p AS (SELECT conv_id, text AS t, lag(text) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations),
s AS (SELECT conv_id, trim(regexp_replace(t, '[^!-~]', ' ', 'g')) AS t, trim(regexp_replace(p, '[^!-~]', ' ', 'g')) AS p FROM p WHERE p IS NOT NULL AND t IS NOT NULL)
SELECT conv_id, CASE WHEN sum(length(p)) > 0 THEN CAST(sum(levenshtein(p, t)) AS DOUBLE) / sum(length(p)) END AS cer FROM s GROUP BY conv_id
""")
def cer_by_turn(spark, sf):
    """The error rate of each whole turn as a guess at the one before it; costs only, which don't depend on the alignment chosen. Characters outside ASCII count as a space each, as the SQL engine's distance goes by bytes."""
    before = F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn"))
    plain = lambda c: F.regexp_replace(c, "[^!-~]", " ")
    pairs = _t(spark, sf, "conversations").select("conv_id", plain(F.col("text")).alias("t"), plain(before).alias("p")).where("p is not null and t is not null")
    return metrics.error_rate(pairs.withColumn("c", metrics.char_edits(F.col("p"), F.col("t"))), "c", "cer", ["conv_id"], normalise=False)


@_query("""
WITH e AS (SELECT p_partkey, p_name AS label, regexp_replace(p_name, '[aeiou]', '', 'g') AS prediction FROM part WHERE p_size > 16 * 0.25),
r AS (SELECT *, CAST(length(label) - length(prediction) AS DOUBLE) / length(label) AS cer, CAST((string_split(label, ' ')[1] <> string_split(prediction, ' ')[1])::INT + (string_split(label, ' ')[2] <> string_split(prediction, ' ')[2])::INT AS DOUBLE) / 2 AS wer FROM e)
SELECT p_partkey, prediction AS asr_prediction, label AS asr_label, 'model' AS asr_validation_model, cer AS asr_cer, wer AS asr_wer FROM r WHERE cer < 0.3
""")
def validations(spark, sf):
    """Names of parts as transcripts of p_size samples at 16 a second, against predictions without vowels."""
    p = _t(spark, sf, "part").select("p_partkey", F.col("p_name").alias("text"), F.array_repeat(F.lit(0.5), F.col("p_size")).alias("audio"), F.regexp_replace(F.upper("p_name"), "[AEIOU]", "").alias("guess"))
    return validation.add_validations(p, "text", "audio", "guess", 16, "model", KEEP, 0.3).drop("text", "audio")


@_query("""
WITH l AS (SELECT l_orderkey AS id, string_agg(chr(CAST(97 + l_partkey % 26 AS INTEGER)), '' ORDER BY l_linenumber, l_partkey) AS t FROM lineitem GROUP BY l_orderkey)
SELECT id % 10 AS part, CAST(sum(1) AS DOUBLE) / sum(length(t)) AS cer, CAST(sum(1) AS DOUBLE) / sum(1) AS wer FROM l GROUP BY id % 10
""")
def token_rates(spark, sf):
    """Orders as ids of letters, and the same without the last one, padded."""
    rows = _labels(spark, sf).select((F.col("id") % 10).alias("part"), F.transform("labels", lambda x: x % 26).alias("labels"))
    cut = F.concat(F.slice("labels", F.lit(1), F.size("labels") - 1), F.array(F.lit(arrays.IGNORED).cast("bigint")))
    return validation.token_error_rates(rows.withColumn("ids", cut), "ids", "labels", {i: chr(97 + i) for i in range(26)}, 26, ["part"])


@_query("""
WITH r AS (SELECT event_id, regexp_replace(event_type, '[^a-z]', '', 'g') AS a, regexp_replace(reverse(event_type), '[^a-z]', '', 'g') AS b FROM events)
SELECT event_id, levenshtein(a, b) / CAST(length(a) AS DOUBLE) AS cer FROM r WHERE length(a) > 0 AND levenshtein(a, b) / CAST(length(a) AS DOUBLE) < 0.9
""")
def cer_filter(spark, sf):
    e = _t(spark, sf, "events").select("event_id", F.regexp_replace("event_type", "[^a-z]", "").alias("a"), F.regexp_replace(F.reverse("event_type"), "[^a-z]", "").alias("b"))
    # alignments are costly: one for each distinct pair, then a join
    pairs = e.select("a", "b").distinct().withColumn("c", metrics.char_edits(F.col("a"), F.col("b"))).withColumn("cer", metrics.row_rate(F.col("c"), normalise=False))
    return e.join(pairs.where(filters.below_rate(F.col("cer"), 0.9)), ["a", "b"]).select("event_id", "cer")


# --- mixing ----------------------------------------------------------------


@_query("SELECT source, count(*) / CAST((SELECT count(*) FROM documents) AS DOUBLE) * 1000 * 60 / count(*) AS epochs FROM documents GROUP BY source")
def exposure(spark, sf):
    d = _t(spark, sf, "documents")
    per = d.groupBy("source").agg(F.count(F.lit(1)).alias("nominal_rows")).join(F.broadcast(d.agg(F.count(F.lit(1)).alias("all_"))))
    return mix.exposure(per.withColumn("probability", F.col("nominal_rows") / F.col("all_")), 1000, 60).select("source", "epochs")


@_query("SELECT lang AS language, round(sum(p), 9) AS share FROM (SELECT lang, source, count(*) / CAST((SELECT count(*) FROM documents) AS DOUBLE) AS p FROM documents GROUP BY lang, source) GROUP BY lang")
def language_share(spark, sf):
    d = _t(spark, sf, "documents")
    per = d.groupBy(F.col("lang").alias("language"), "source").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(d.agg(F.count(F.lit(1)).alias("all_"))))
    return mix.language_share(per.withColumn("probability", F.col("n") / F.col("all_"))).select("language", F.round("share", 9).alias("share"))


@_query("""
WITH w AS (
  SELECT lang, CASE lang WHEN 'en' THEN 5 WHEN 'fr' THEN 3 WHEN 'de' THEN 2 ELSE 1 END AS w, count(*) AS n, row_number() OVER (ORDER BY lang NOT IN ('en', 'fr', 'de') OR lang IS NULL, lang IS NULL, lang) - 1 AS source FROM documents GROUP BY lang
), p AS (
  SELECT *, w / CAST(sum(w) OVER () AS DOUBLE) AS p FROM w
), h AS (
  SELECT *, max(n / p) OVER () AS horizon FROM p
), d AS (
  SELECT *, greatest(n, CAST(floor(horizon * p) AS BIGINT)) AS drawn FROM h
), r AS (
  SELECT doc_id, d.*, row_number() OVER (PARTITION BY d.source ORDER BY doc_id) - 1 AS place FROM documents x JOIN d ON x.lang IS NOT DISTINCT FROM d.lang
), k AS (
  SELECT *, unnest(range(0, CAST(floor((drawn - 1 - place) / CAST(n AS DOUBLE)) AS BIGINT) + 1)) AS round FROM r
)
SELECT doc_id, lang, CAST(round AS INTEGER) AS round, CAST(source AS INTEGER) AS source,
  (round * n + place + CAST(('0x' || substr(md5('4242' || chr(1) || source || chr(1) || (round * n + place)), 1, 5)) AS BIGINT) / CAST(1048576 AS DOUBLE)) / p AS step FROM k
""")
def interleave(spark, sf):
    d = _t(spark, sf, "documents").select("doc_id", "lang")
    # a source for each language that occurs, null too
    langs = sorted((r.lang for r in d.select("lang").distinct().collect()), key=lambda x: (x not in LANGUAGES, x is None, x or ""))
    weights = [LANGUAGES.get(x, 1) for x in langs]
    parts = [d.where(F.col("lang").eqNullSafe(F.lit(x))) for x in langs]
    return mix.interleave(parts or [d], ["doc_id"], seed=4242, probabilities=[w / sum(weights) for w in weights] or [1.0])


@_query("SELECT o_orderkey, row_number() OVER (ORDER BY md5('4242' || chr(1) || o_orderkey), o_orderkey) - 1 AS place FROM orders")
def seeded_shuffle(spark, sf):
    """Orders with their places in a shuffle."""
    ranked = _t(spark, sf, "orders").select("o_orderkey", mix.shuffle_rank(4242, "o_orderkey").alias("rank"))
    return numbered(ranked, ["rank", "o_orderkey"], "shuffled", "place").select("o_orderkey", "place")


@_query("""
WITH n AS (SELECT *, row_number() OVER (ORDER BY l_orderkey, l_linenumber) - 1 AS r FROM lineitem)
SELECT r // 60 AS batch, count(*) AS rows, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM n WHERE r // 60 < (SELECT count(*) FROM lineitem) // 60 GROUP BY r // 60
""")
def batches(spark, sf):
    out = mix.batches(_t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"], 60)
    return out.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.sum("l_linenumber").alias("lines"))


# --- arrays ----------------------------------------------------------------

_LABELS_SQL = "SELECT l_orderkey AS id, l_orderkey // 8 AS batch, array_agg(l_partkey ORDER BY l_linenumber, l_partkey) AS labels FROM lineitem GROUP BY l_orderkey"


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    rows = _t(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("r"))
    return rows.select("id", F.floor(F.col("id") / 8).alias("batch"), F.col("r.l_partkey").cast("array<bigint>").alias("labels"))


@_query(f"""
WITH l AS ({_LABELS_SQL}), w AS (SELECT *, max(len(labels)) OVER (PARTITION BY batch) AS width FROM l)
SELECT id, array_to_string(list_resize(labels, width, -100), ',') AS padded, array_to_string(list_resize(list_transform(labels, lambda x: 1), width, 0), ',') AS mask FROM w
""")
def pad_longest(spark, sf):
    width = arrays.batch_width(F.size("labels"), Window.partitionBy("batch"))
    rows = _labels(spark, sf).withColumn("width", width)
    return rows.select("id", F.array_join(arrays.pad_labels(F.col("labels"), F.col("width")).cast("array<string>"), ",").alias("padded"), F.array_join(arrays.attention_mask(F.size("labels"), F.col("width")).cast("array<string>"), ",").alias("mask"))


@_query(f"""
WITH l AS ({_LABELS_SQL})
SELECT id, array_to_string(list_concat([7, 8, 9], labels[:3]), ',') AS decoder, array_to_string(list_concat([-100, -100], labels[:3], [2]), ',') AS labels FROM l
""")
def prompt_labels(spark, sf):
    prompt = F.array(*[F.lit(x) for x in (7, 8, 9)])
    decoder, labels = arrays.prompt_batch_row(prompt, F.col("labels"), 2, max_length=6)
    return _labels(spark, sf).select("id", F.array_join(decoder.cast("array<string>"), ",").alias("decoder"), F.array_join(labels.cast("array<string>"), ",").alias("labels"))


@_query(f"WITH l AS ({_LABELS_SQL}) SELECT id, CASE WHEN id % 3 = 0 THEN true ELSE id % 3 = 1 END AS valid FROM l")
def transducer_check(spark, sf):
    rows = _labels(spark, sf)
    given = F.when(F.col("id") % 3 == 1, arrays.transducer_inputs(F.col("labels"), 0)).when(F.col("id") % 3 == 2, F.col("labels"))
    return rows.select("id", arrays.transducer_is_valid(given, F.col("labels"), 0).alias("valid"))


@_query("SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE) / list_max(list_transform(embedding, lambda y: abs(CAST(y AS DOUBLE))))))), 6) AS total FROM embeddings")
def peak_normalise(spark, sf):
    a = arrays.peak_normalise(F.col("embedding").cast("array<double>"))
    return _t(spark, sf, "embeddings").select("vec_id", F.round(F.aggregate(a, F.lit(0.0), lambda s, x: s + F.abs(x)), 6).alias("total"))


@_query("SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS best FROM embeddings")
def logits_argmax(spark, sf):
    return _t(spark, sf, "embeddings").select("vec_id", arrays.argmax(F.col("embedding")).cast("int").alias("best"))


@_query("SELECT vec_id, len(embedding) / CAST(16 AS DOUBLE) AS seconds, CAST(list_resize(embedding[:80], 80, 0)[80] AS DOUBLE) AS last FROM embeddings")
def fit_length(spark, sf):
    a = arrays.fit_length(F.col("embedding").cast("array<double>"), 80, F.lit(0.0))
    return _t(spark, sf, "embeddings").select("vec_id", arrays.num_seconds(F.col("embedding"), 16).alias("seconds"), F.element_at(a, 80).alias("last"))


@_query("SELECT n_nationkey, least(CAST(300 AS DOUBLE), 2.5 * pow(2, least(n_nationkey, 7))) AS delay FROM nation")
def retry_delay(spark, sf):
    return _t(spark, sf, "nation").select("n_nationkey", scalars.retry_delay(F.col("n_nationkey"), 2.5, 300.0).alias("delay"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)
