"""Queries of the curation operators and their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.functions import text as X
from siftwork.functions import values as V
from siftwork.functions.keys import norm_key
from siftwork.operators import decide, dedup, flatten, images, profile, release, sampling, search, splitting, validate
from siftwork.plans import flat_sql
from siftwork.plans.registry import Registry, table
from siftwork.session import shared_dir
from siftwork.sources import readers, writers
from siftwork.streaming import jobs

R = Registry()
SEED = "siftwork-1"
SPACE_RE2 = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]+"
HOST = "ids.museum.example"

#: Example rules of the queries below; the operators take any.
ID_LIKE = r"(?i)(?U)^(?:object|item|specimen|record)\s*[-#:]*\s*\d+$"
REVIEW = ("fire", "flood", "c. 1664", "horn")
GROUPS = (("ceramics", ("bowl", "vase", "tile", "plate")), ("engines", ("engine", "pump", "valve")), ("paper", ("letter", "ledger", "stamp", "print")))
CATEGORIES = ("archaeology", "space_aviation", "science_technology", "historical_objects", "coins_stamps_documents", "other_objects", "decorative_arts_design", "art", "natural_history")


def meta(spark: SparkSession, d: str) -> DataFrame:
    """metadata, whole-row copies taken out."""
    return table(spark, d, "metadata").distinct()


META = "(SELECT DISTINCT * FROM metadata)"


def _re2_terms(terms: tuple[str, ...]) -> str:
    return "(^|[^\\pL\\pN_\\pM])(" + "|".join(t.replace(".", "\\.") for t in terms) + ")([^\\pL\\pN_\\pM]|$)"


def _contains_any(column: str, words: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{w}')" for w in words) + ")"


# --- decisions -------------------------------------------------------------------------------------------------------


def _decided(spark: SparkSession, d: str) -> DataFrame:
    hard = [
        [decide.Rule("NOT_OPEN", ~F.coalesce(F.col("metadata_rights") == "CC0", F.lit(False))), decide.Rule("NOT_OPEN_MEDIA", ~F.coalesce(F.col("media_rights") == "CC0", F.lit(False)))],
        [decide.Rule(f"MISSING_{c.upper()}", ~X.present(c)) for c in ("object_id", "media_id", "source_url")],
        [decide.Rule("LOW_TEXT_QUALITY", decide.useful_fields(("title", "description", "object_type", "date", "topics", "creator", "place"), "title", ("untitled", "unknown"), ID_LIKE) < 2)],
    ]
    soft = [decide.Rule("TERM_REVIEW", X.contains_term(F.concat_ws(" ", "title", "description"), REVIEW))]
    category = decide.decision_list([(decide.keyword_rule(("title", "object_type", "topics"), words), name) for name, words in GROUPS], "other")
    return meta(spark, d).withColumn("decision", decide.decision(hard, soft)).select("image_id", "object_id", "unit_code", F.col("decision.status").alias("status"), F.col("decision.reasons").alias("reasons"), category.alias("group"))


def _p(c: str) -> str:
    return f"coalesce(trim(regexp_replace({c}, '{SPACE_RE2}', ' ', 'g')) <> '', false)"


DECIDED = f"""(SELECT *, CASE WHEN len(r1) > 0 OR len(r2) > 0 OR len(r3) > 0 THEN 'rejected' WHEN len(r4) > 0 THEN 'review_required' ELSE 'eligible' END AS status,
  CASE WHEN len(r1) > 0 THEN r1 WHEN len(r2) > 0 THEN r2 WHEN len(r3) > 0 THEN r3 ELSE r4 END AS reasons FROM (
  SELECT image_id, object_id, unit_code,
   list_filter([CASE WHEN metadata_rights IS DISTINCT FROM 'CC0' THEN 'NOT_OPEN' END, CASE WHEN media_rights IS DISTINCT FROM 'CC0' THEN 'NOT_OPEN_MEDIA' END], lambda x: x IS NOT NULL) AS r1,
   list_filter([CASE WHEN NOT {_p('object_id')} THEN 'MISSING_OBJECT_ID' END, CASE WHEN NOT {_p('media_id')} THEN 'MISSING_MEDIA_ID' END, CASE WHEN NOT {_p('source_url')} THEN 'MISSING_SOURCE_URL' END], lambda x: x IS NOT NULL) AS r2,
   list_filter([CASE WHEN {' + '.join(f'CAST({_p(c)} AS INT)' for c in ('title', 'description', 'object_type', 'date', 'topics', 'creator', 'place'))}
     - CAST({_p('title')} AND (lower(trim(title)) IN ('untitled', 'unknown') OR regexp_full_match(lower(trim(title)), '(object|item|specimen|record)\\s*[-#:]*\\s*[0-9]+')) AS INT) < 2 THEN 'LOW_TEXT_QUALITY' END], lambda x: x IS NOT NULL) AS r3,
   list_filter([CASE WHEN regexp_matches(lower(concat_ws(' ', title, description)), '{_re2_terms(REVIEW)}') THEN 'TERM_REVIEW' END], lambda x: x IS NOT NULL) AS r4,
   CASE {' '.join(f"WHEN {_contains_any('k', words)} THEN '{name}'" for name, words in GROUPS)} ELSE 'other' END AS "group"
  FROM (SELECT *, lower(concat_ws(' ', title, object_type, topics)) AS k FROM {META})))"""


@R.query(f"""SELECT "group", status, CAST(count(*) AS BIGINT) AS n, CAST(count(DISTINCT object_id) AS BIGINT) AS objects FROM {DECIDED} GROUP BY 1, 2""")
def eligible_category_counts(spark, d):
    return _decided(spark, d).groupBy("group", "status", "object_id").agg(F.count("*").alias("m")).groupBy("group", "status").agg(F.sum("m").alias("n"), F.count("object_id").alias("objects"))


@R.query(f"SELECT image_id, status, array_to_string(reasons, '|') AS reasons FROM {DECIDED}")
def eligibility_decisions(spark, d):
    return _decided(spark, d).select("image_id", "status", F.array_join("reasons", "|").alias("reasons"))


@R.query(f"SELECT status, count(*) AS n FROM {DECIDED} GROUP BY 1")
def status_counts(spark, d):
    return decide.status_counts(_decided(spark, d))


@R.query(f"SELECT reason, count(*) AS n FROM (SELECT unnest(reasons) AS reason FROM {DECIDED}) GROUP BY 1")
def reason_counts(spark, d):
    return decide.reason_counts(_decided(spark, d))


@R.query(f"SELECT count(*) AS total, count(*) FILTER (status IN ('eligible', 'review_required')) AS usable, round_even(count(*) FILTER (status IN ('eligible', 'review_required')) / count(*), 4) AS ratio FROM {DECIDED}")
def usable_ratio(spark, d):
    return profile.usable_ratio(_decided(spark, d), "status", ("eligible", "review_required"))


@R.query(f"SELECT doc_id, regexp_matches(lower(text), '{_re2_terms(('ledger', 'maker', 'p. 75'))}') AS hit FROM documents WHERE text IS NOT NULL")
def word_term_match(spark, d):
    return table(spark, d, "documents").where("text IS NOT NULL").select("doc_id", X.contains_term("text", ("ledger", "maker", "p. 75")).alias("hit"))


@R.query(f"""SELECT category_code, CASE category_code WHEN 'art' THEN 'Art' WHEN 'natural_history' THEN 'Natural history' ELSE 'Other' END AS label, count(*) AS n FROM {META} WHERE category_code IN ('art', 'natural_history', 'archaeology') GROUP BY ALL""")
def category_labels(spark, d):
    labels = {"art": "Art", "natural_history": "Natural history", "archaeology": "Other"}
    return meta(spark, d).where(F.col("category_code").isin(*labels)).groupBy("category_code").agg(F.count("*").alias("n")).select("category_code", decide.lookup("category_code", labels).alias("label"), "n")


# --- text ------------------------------------------------------------------------------------------------------------

_UNESCAPE = "replace(replace(replace(replace(replace({c}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&')"


def _sql_clean(c: str) -> str:
    return f"nullif(trim(regexp_replace(regexp_replace({_UNESCAPE.format(c=c)}, '<[^>]+>', '', 'g'), '{SPACE_RE2}', ' ', 'g')), '')"


def _sql_strip(c: str) -> str:
    return f"nullif(trim(regexp_replace({c}, '{SPACE_RE2}', ' ', 'g'), ' ;,.'), '')"


def _sql_cut(t: str, n: int) -> str:
    head = f"rtrim({t}[1:{n - 1}])"
    return f"CASE WHEN length({t}) <= {n} THEN {t} WHEN contains({head}, ' ') THEN rtrim(regexp_replace({head}, ' [^ ]*$', ''), ' ;,.') || '…' ELSE {head} || '…' END"


@R.query(f"SELECT image_id, {_sql_clean('title')} AS title, {_sql_clean('description')} AS description FROM {META}")
def clean_titles(spark, d):
    return meta(spark, d).select("image_id", X.clean_text("title", "basic").alias("title"), X.clean_text("description", "basic").alias("description"))


@R.query(f"SELECT image_id, {_sql_clean('title')} AS title FROM {META}")
def decoded_titles(spark, d):
    """With every HTML entity decoded; the tables hold no others than the five."""
    return meta(spark, d).select("image_id", X.clean_text("title").alias("title"))


@R.query(f"SELECT image_id, {_sql_cut('t', 60)} AS short FROM (SELECT image_id, {_sql_strip('description')} AS t FROM {META})")
def truncated_texts(spark, d):
    return meta(spark, d).select("image_id", X.truncate_words(X.strip_ends("description"), 60).alias("short"))


_PART_SQL = ", ".join(f"{{'l': {'NULL' if label is None else repr(label)}, 'v': {_sql_strip(c if c != 'date' else chr(34) + 'date' + chr(34))}}}" for label, c in X.PARTS)


@R.query(f"""SELECT image_id, CASE WHEN length(t) <= 512 THEN t ELSE rtrim({_sql_cut('t', 511)}, '.') || '.' END AS model_text FROM (
 SELECT image_id, CASE WHEN len(s) > 0 THEN array_to_string(s, '. ') || '.' ELSE '' END AS t FROM (
  SELECT image_id, list_concat(list_transform(list_filter(p, lambda x, i: list_position(low, lower(x.v)) = i), lambda x: CASE WHEN x.l IS NULL THEN x.v ELSE x.l || ': ' || x.v END),
    CASE WHEN q IS NOT NULL AND NOT list_contains(low, lower(q)) THEN ['Description: ' || {_sql_cut('q', 240)}] ELSE [] END) AS s FROM (
   SELECT *, list_transform(p, lambda x: lower(x.v)) AS low FROM (
    SELECT image_id, list_filter([{_PART_SQL}], lambda x: x.v IS NOT NULL) AS p, {_sql_strip('description')} AS q FROM {META}))))""")
def model_texts(spark, d):
    return meta(spark, d).select("image_id", X.model_text().alias("model_text"))


@R.query("""SELECT media_host, netloc, count(*) AS n FROM (SELECT CASE WHEN contains(media_url, '://') THEN lower(split_part(media_url, '/', 3)) ELSE '' END AS media_host,
 coalesce(regexp_extract(media_url, '^[^:/?#]+://([^/?#]*)', 1), '') AS netloc FROM metadata) GROUP BY 1, 2""")
def media_hosts(spark, d):
    return table(spark, d, "metadata").select(X.media_host("media_url").alias("media_host"), X.netloc("media_url").alias("netloc")).groupBy("media_host", "netloc").agg(F.count("*").alias("n"))


@R.query(f"""SELECT image_id, CASE WHEN lower(regexp_extract(media_url, '^[^:/?#]+://([^/?#]*)', 1)) <> '{HOST}' THEN media_url
 WHEN regexp_matches(media_url, '/ids/deliveryService/?\\?(.*&)?id=') THEN CASE WHEN regexp_matches(media_url, '[?&]max=') THEN regexp_replace(media_url, '([?&])max=[^&]*', '\\1max=256') ELSE media_url || '&max=256' END
 WHEN contains(media_url, '/ids/deliveryService/id/') THEN regexp_replace(rtrim(media_url, '/'), '/[0-9]+$', '') || '/256' ELSE media_url END AS image_url FROM {META}""")
def derivative_urls(spark, d):
    return meta(spark, d).select("image_id", X.derivative_url("media_url", HOST, 256).alias("image_url"))


@R.query(f"SELECT image_id, sha256('{SEED}:' || coalesce(object_id, '') || '|' || coalesce(media_id, '') || '|' || coalesce(media_url, '')) AS selection_hash, sha256('{SEED}:' || coalesce(object_id, 'None') || '|' || coalesce(media_id, 'None')) AS starter_hash, lpad(CAST(image_id AS VARCHAR), 8, '0') || '.jpg' AS file_name FROM {META}")
def seeded_ranks(spark, d):
    return meta(spark, d).select("image_id", V.seeded_sha(SEED, ["object_id", "media_id", "media_url"]).alias("selection_hash"), V.seeded_sha(SEED, ["object_id", "media_id"], null_as="None").alias("starter_hash"), V.file_name("image_id").alias("file_name"))


@R.query(f"SELECT image_id, CASE WHEN height = 0 THEN 0.0 ELSE coalesce(width / height, 0.0) END AS aspect, round_even(CASE WHEN height = 0 THEN 0.0 ELSE coalesce(width / height, 0.0) END, 4) AS aspect4 FROM {META}")
def aspect_ratios(spark, d):
    return meta(spark, d).select("image_id", V.ratio("width", "height").alias("aspect"), V.ratio("width", "height", 4).alias("aspect4"))


@R.query(f"""SELECT image_id, list_filter([CASE WHEN width IS NULL OR height IS NULL THEN 'DECODE_FAILURE' END, CASE WHEN greatest(width, height) < 256 THEN 'TOO_SMALL' END], lambda x: x IS NOT NULL)::VARCHAR AS errors,
 CASE WHEN width / nullif(height, 0) > 8 OR width / nullif(height, 0) < 0.125 THEN '[EXTREME_ASPECT]' ELSE '[]' END AS flags FROM {META}""")
def image_quality(spark, d):
    c = images.image_checks()
    return meta(spark, d).select("image_id", F.concat(F.lit("["), F.array_join(c["errors"], ", "), F.lit("]")).alias("errors"), F.concat(F.lit("["), F.array_join(c["flags"], ", "), F.lit("]")).alias("flags"))


# --- duplicates and shared keys --------------------------------------------------------------------------------------


def _inputs(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "object_id", "title", "lang")
    return [docs.where("lang = 'en'").drop("lang"), docs.where("lang IS DISTINCT FROM 'en'").drop("lang")]


_MERGED = """(SELECT *, row_number() OVER (PARTITION BY coalesce(object_id, ''), coalesce(title, '') ORDER BY input, doc_id) AS r FROM
 (SELECT doc_id, object_id, title, CASE WHEN lang = 'en' THEN 0 ELSE 1 END AS input FROM documents))"""


@R.query(f"SELECT doc_id, object_id, title, input FROM {_MERGED} WHERE r = 1")
def merge_first_wins(spark, d):
    return dedup.merge_first_wins(_inputs(spark, d), ["object_id", "title"], "doc_id").select("doc_id", "object_id", "title", "input")


@R.query(f"SELECT input, count(*) AS read, count(*) FILTER (r = 1) AS kept, count(*) FILTER (r > 1) AS skipped FROM {_MERGED} GROUP BY 1")
def merge_report(spark, d):
    return dedup.merge_report(_inputs(spark, d), ["object_id", "title"], "doc_id")


@R.query("SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY coalesce(object_id, ''), coalesce(title, '') ORDER BY doc_id) AS r FROM documents) WHERE r > 1")
def duplicate_pairs(spark, d):
    return dedup.duplicate_pairs(table(spark, d, "documents").select("doc_id", "object_id", "title"), ["object_id", "title"], "doc_id").select("doc_id")


_SHARED = f"""(SELECT media_id, count(DISTINCT object_id) AS object_count, count(*) AS row_count, array_to_string(list_sort(list(DISTINCT object_id)), '; ') AS objects, array_to_string(list_sort(list(DISTINCT unit_code) FILTER (unit_code IS NOT NULL)), '; ') AS units
 FROM {META} WHERE coalesce(trim(media_id), '') <> '' AND coalesce(trim(object_id), '') <> '' GROUP BY 1 HAVING count(DISTINCT object_id) > 1)"""


@R.query(f"SELECT * FROM {_SHARED}")
def shared_media(spark, d):
    return dedup.shared_keys(meta(spark, d), "media_id", "object_id", "unit_code")


@R.query(f"SELECT image_id, media_id IN (SELECT media_id FROM {_SHARED}) IS TRUE AS shared FROM {META}")
def shared_media_flags(spark, d):
    m = meta(spark, d)
    return dedup.flag_members(m.select("image_id", "media_id"), dedup.shared_objects(m, "media_id", "object_id", "unit_code"), "media_id", "shared").select("image_id", "shared")


@R.query(f"SELECT media_id, object_id, unit_code, count(*) AS n FROM {META} WHERE media_id IN (SELECT media_id FROM {_SHARED}) AND coalesce(trim(object_id), '') <> '' GROUP BY 1, 2, 3")
def shared_media_objects(spark, d):
    return dedup.shared_objects(meta(spark, d), "media_id", "object_id", "unit_code")


@R.query(f"SELECT media_id, image_id, count(*) OVER (PARTITION BY media_id) AS group_size FROM {META} WHERE coalesce(trim(media_id), '') <> '' QUALIFY group_size > 1")
def same_media_members(spark, d):
    return dedup.duplicate_groups(meta(spark, d), "media_id", "image_id")


_HASHED = f"(SELECT image_id, nullif(lower(trim(sha256)), '') AS sha FROM {META})"


@R.query(f"SELECT sha, image_id, kept_id FROM (SELECT sha, image_id, min(image_id) OVER (PARTITION BY sha) AS kept_id FROM {_HASHED} WHERE sha IS NOT NULL) WHERE image_id > kept_id")
def exact_duplicates(spark, d):
    return dedup.exact_duplicates(meta(spark, d).select("image_id", norm_key("sha256").alias("sha")), "sha", "image_id")


@R.query(f"SELECT * FROM (SELECT sha, image_id, count(*) OVER (PARTITION BY sha) AS group_size FROM {_HASHED} WHERE sha IS NOT NULL) WHERE group_size > 1")
def duplicate_groups(spark, d):
    return dedup.duplicate_groups(meta(spark, d).select("image_id", norm_key("sha256").alias("sha")), "sha", "image_id")


@R.query(f"""SELECT media_id, count(*) AS n, array_to_string(list_sort(list(image_id)), '; ') AS ids, array_to_string(list_sort(list(DISTINCT object_id)), '; ') AS objects FROM {META} WHERE coalesce(trim(media_id), '') <> '' GROUP BY 1 HAVING count(*) > 1""")
def same_media_groups(spark, d):
    return dedup.grouped_ids(meta(spark, d), "media_id", "image_id", "object_id")


_BITS = f"(SELECT image_id, lower(trim(sha256)) AS sha, CAST('0x' || lower(trim(phash)) AS UBIGINT) AS h FROM {META} WHERE regexp_full_match(lower(trim(phash)), '[0-9a-f]{{16}}'))"
_NEAR = f"(SELECT x.image_id AS a, y.image_id AS b, CAST(bit_count(xor(x.h, y.h)) AS INT) AS distance FROM {_BITS} x JOIN {_BITS} y ON x.image_id < y.image_id WHERE bit_count(xor(x.h, y.h)) <= 4 AND x.sha IS DISTINCT FROM y.sha)"


def _near_columns(m: DataFrame) -> DataFrame:
    return m.select("image_id", "object_id", F.lower(F.trim("sha256")).alias("sha"), V.hex_bits("phash").alias("h"))


def _near(spark, d):
    m = _near_columns(meta(spark, d))
    return dedup.hamming_pairs(m, "image_id", "h", 4, other="sha"), m


def _near_edges(spark, d):
    """Edges with the components of the pairs of :func:`_near`. Whole-row copies change no component, so they are not taken
    out of the wide rows first."""
    m = _near_columns(table(spark, d, "metadata"))
    return dedup.hamming_edges(m, "image_id", "h", 4, other="sha"), m


@R.query(f"SELECT a, b, distance FROM {_NEAR}")
def hamming_near_pairs(spark, d):
    return _near(spark, d)[0]


@R.query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {_NEAR} UNION ALL SELECT b, a FROM {_NEAR}), r(node, root) AS (SELECT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
 c AS (SELECT node, min(root) AS first_id FROM r GROUP BY 1)
 SELECT row_number() OVER (ORDER BY size DESC, first_id) AS group_id, * FROM (SELECT first_id, count(*) AS size, count(DISTINCT object_id) AS object_count, array_to_string(list_sort(list(node)), '; ') AS ids FROM c JOIN {META} m ON m.image_id = c.node GROUP BY 1)""")
def near_components(spark, d):
    edges, m = _near_edges(spark, d)
    return dedup.near_components(edges, m, "image_id", "object_id")


@R.query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {_NEAR} UNION ALL SELECT b, a FROM {_NEAR}), r(node, root) AS (SELECT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
 SELECT min(root) AS first_id, node AS id FROM r GROUP BY 2""")
def near_component_members(spark, d):
    return dedup.component_members(_near_edges(spark, d)[0])


def _distinct(c: str) -> str:
    return f"array_to_string(list_sort(list(DISTINCT coalesce({c}, ''))), '; ')"


@R.query(f"""WITH RECURSIVE e AS (SELECT a, b FROM {_NEAR} UNION ALL SELECT b, a FROM {_NEAR}), r(node, root) AS (SELECT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
 c AS (SELECT node, min(root) AS first_id FROM r GROUP BY 1)
 SELECT row_number() OVER (ORDER BY size DESC, first_id) AS group_id, * FROM (SELECT first_id, count(*) AS size, count(DISTINCT object_id) AS object_count, array_to_string(list_sort(list(node)), '; ') AS ids,
 {_distinct("object_id")} AS objects, {_distinct("category")} AS categories, {_distinct("unit_code")} AS units FROM c JOIN {META} m ON m.image_id = c.node GROUP BY 1)""")
def near_component_lists(spark, d):
    pairs, _ = _near(spark, d)
    return dedup.near_components(pairs.select("a", "b"), meta(spark, d), "image_id", "object_id", objects="object_id", categories="category", units="unit_code")


# --- profiles --------------------------------------------------------------------------------------------------------


@R.query(f"""SELECT 'unit_code' AS "column", coalesce(unit_code, '') AS value, count(*) AS n FROM {META} GROUP BY 2 UNION ALL SELECT 'institution', coalesce(institution, ''), count(*) FROM {META} GROUP BY 2""")
def value_frequencies(spark, d):
    return profile.frequencies(meta(spark, d), ["unit_code", "institution"])


@R.query(f"SELECT token, count(*) AS n FROM (SELECT trim(unnest(string_split(object_type, ';'))) AS token FROM {META}) WHERE token <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 100")
def top_tokens(spark, d):
    return profile.token_frequencies(meta(spark, d), "object_type")


_MISS = ("title", "description", "culture", "creator", "alt_text")


@R.query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL OR {c} = '') AS missing, count(*) AS total, round_even(count(*) FILTER ({c} IS NULL OR {c} = '') / count(*), 4) AS ratio FROM {META}" for c in _MISS))
def missing_profile(spark, d):
    return profile.missing(meta(spark, d), _MISS)


@R.query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER (NOT {_p(c)}) AS missing, count(*) AS total, round_even(count(*) FILTER (NOT {_p(c)}) / count(*), 4) AS ratio FROM {META}" for c in _MISS))
def blank_profile(spark, d):
    return profile.missing(meta(spark, d), _MISS, blank=True)


@R.query("SELECT count(value) AS n, round(avg(value), 6) AS mean, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, round(min(value), 6) AS least, round(max(value), 6) AS most FROM events")
def summary_stats(spark, d):
    return profile.summary(table(spark, d, "events"), "value").select("n", *[F.round(c, 6).alias(c) for c in ("mean", "p50", "p95", "least", "most")])


@R.query(f"SELECT count(object_id) AS objects, CAST(sum(n) AS BIGINT) AS \"rows\", count(*) FILTER (n > 1) AS multi_row_objects, max(n) AS most_rows FROM (SELECT object_id, count(*) AS n FROM {META} GROUP BY 1)")
def multi_view_objects(spark, d):
    return profile.group_sizes(meta(spark, d), "object_id")


@R.query(f"SELECT category_code, count(*) AS \"rows\", count(DISTINCT object_id) AS objects FROM {META} GROUP BY 1")
def category_supply(spark, d):
    return profile.supply(meta(spark, d), "category_code", "object_id")


@R.query("SELECT round(avg(n_chars), 6) AS mean_bytes, round((avg(n_chars) * 25000 + 1000000) / 1e9, 9) AS projected_gb, CASE WHEN (avg(n_chars) * 25000 + 1000000) / 1e9 <= 0.03 THEN 'GO' WHEN (avg(n_chars) * 25000 + 1000000) / 1e9 <= 0.05 THEN 'ADJUST' ELSE 'STOP' END AS verdict FROM documents")
def package_gate(spark, d):
    return profile.package_projection(table(spark, d, "documents"), "n_chars", 25_000, 1_000_000, 0.03, 0.05).select(F.round("mean_bytes", 6).alias("mean_bytes"), F.round("projected_gb", 9).alias("projected_gb"), "verdict")


@R.query(f"SELECT image_id, width, height FROM {META} WHERE height > width")
def anomaly_filter(spark, d):
    return profile.anomalies(meta(spark, d).select("image_id", "width", "height"), "height", "width")


@R.query("""SELECT k AS key, CASE json_type(j, '$."' || k || '"') WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END AS kind, count(*) AS n
 FROM (SELECT TRY_CAST(props AS JSON) AS j, unnest(json_keys(TRY_CAST(props AS JSON))) AS k FROM events) GROUP BY 1, 2""")
def json_profile(spark, d):
    return profile.json_keys(table(spark, d, "events"), "props")


@R.query(f"SELECT institution, collection, n FROM (SELECT *, row_number() OVER (PARTITION BY institution ORDER BY n DESC, collection) AS r FROM (SELECT institution, collection, count(*) AS n FROM {META} WHERE institution IS NOT NULL AND collection IS NOT NULL GROUP BY 1, 2)) WHERE r <= 3")
def top_collections(spark, d):
    counts = meta(spark, d).where("institution IS NOT NULL AND collection IS NOT NULL").groupBy("institution", "collection").agg(F.count("*").alias("n"))
    return profile.top_per_key(counts, "institution", "collection", "n", 3)


@R.query(f"SELECT image_id, height FROM {META} WHERE height > width ORDER BY image_id LIMIT 10")
def first_portrait_samples(spark, d):
    return profile.first_samples(meta(spark, d).select("image_id", "width", "height"), "height > width", ["image_id"], 10).select("image_id", "height")


@R.query(f"SELECT coalesce(creator, '') AS value, count(*) AS n FROM {META} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 30")
def top_creators(spark, d):
    return sampling.top_values(meta(spark, d).select(F.coalesce("creator", F.lit("")).alias("creator")), "creator", 30)


# --- sampling --------------------------------------------------------------------------------------------------------

_HASH_SQL = f"sha256('{SEED}:' || coalesce(object_id, '') || '|' || coalesce(media_id, '') || '|' || CAST(image_id AS VARCHAR))"


def _ranked(spark, d):
    return meta(spark, d).withColumn("h", V.seeded_sha(SEED, ["object_id", "media_id", "image_id"]))


@R.query(f"""SELECT category_code, CAST(f + CASE WHEN r <= 500 - s THEN 1 ELSE 0 END AS BIGINT) AS quota FROM (SELECT *, row_number() OVER (ORDER BY x - f DESC, category_code) AS r, sum(f) OVER () AS s FROM
 (SELECT category_code, 500 * n / t AS x, floor(500 * n / t) AS f FROM (SELECT category_code, count(*) AS n, sum(count(*)) OVER () AS t FROM {META} WHERE category_code IS NOT NULL GROUP BY 1)))""")
def largest_remainder(spark, d):
    groups = meta(spark, d).where("category_code IS NOT NULL").groupBy("category_code").agg(F.count("*").alias("n"))
    return sampling.allocate(groups, "category_code", "n", 500)


@R.query(f"SELECT category_code, image_id FROM (SELECT category_code, image_id, row_number() OVER (PARTITION BY category_code ORDER BY {_HASH_SQL}, image_id) AS r FROM {META}) WHERE r <= 12")
def pilot_top_per_group(spark, d):
    return sampling.top_per_group(_ranked(spark, d), "category_code", ["h", "image_id"], 12).select("category_code", "image_id")


_SHARDS = f"""(SELECT source_unit, source_shard_url, row_number() OVER (PARTITION BY source_unit ORDER BY sha256('{SEED}:' || upper(source_unit) || ':' || string_split(source_shard_url, '/')[-1]), source_shard_url) - 1 AS shard_pos FROM (SELECT DISTINCT source_unit, source_shard_url FROM source_records))"""


@R.query(f"SELECT source_unit, source_shard_url, shard_pos FROM {_SHARDS} WHERE shard_pos BETWEEN 1 AND 3")
def shard_slice(spark, d):
    return sampling.shard_order(table(spark, d, "source_records"), SEED, "source_unit", "source_shard_url", 1, 3)


@R.query(f"""SELECT line_id FROM (SELECT *, row_number() OVER (PARTITION BY source_unit ORDER BY shard_pos, source_unit, line_id) AS r FROM source_records JOIN {_SHARDS} USING (source_unit, source_shard_url)) WHERE r <= 20 ORDER BY shard_pos, source_unit, line_id LIMIT 150""")
def round_robin_cap(spark, d):
    rows = table(spark, d, "source_records").select("line_id", "source_unit", "source_shard_url")
    pos = sampling.shard_order(rows, SEED, "source_unit", "source_shard_url")
    return sampling.round_robin_cap(rows.join(pos, ["source_unit", "source_shard_url"]), "source_unit", ["shard_pos", "source_unit", "line_id"], 20, 150).select("line_id")


QUOTAS = dict(zip(CATEGORIES, (40, 25, 25, 80, 25, 30, 25, 60, 120)))


def _greedy_sql(views: int, inst: int | None) -> str:
    """The loop itself: one row after the other in the order of the categories, with the objects and institutions taken."""
    quota = "(VALUES " + ", ".join(f"('{c}', {k}, {n})" for k, (c, n) in enumerate(QUOTAS.items(), 1)) + ") q(c, k, quota)"
    room = f"AND len(list_filter(s.insts, lambda x: x = b.i)) < {inst}" if inst else ""
    ok = f"(CASE WHEN b.k = s.k THEN s.got ELSE 0 END < b.quota AND len(list_filter(s.objs, lambda x: x = b.o)) < {views} {room})"
    return f"""WITH RECURSIVE b AS MATERIALIZED (SELECT image_id, q.c, q.k, quota, o, i, row_number() OVER (ORDER BY q.k, h, image_id) AS n FROM (SELECT image_id, lower(trim(category_code)) AS c, coalesce(lower(trim(object_id)), '') AS o, coalesce(lower(trim(institution)), '') AS i, {_HASH_SQL} AS h FROM {META}) r JOIN {quota} ON q.c = r.c),
 s(n, image_id, c, k, got, objs, insts) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), 0, 0, CAST([] AS VARCHAR[]), CAST([] AS VARCHAR[])
  UNION ALL SELECT b.n, CASE WHEN {ok} THEN b.image_id END, b.c, b.k, CASE WHEN b.k = s.k THEN s.got ELSE 0 END + CAST({ok} AS INT), CASE WHEN {ok} THEN list_append(s.objs, b.o) ELSE s.objs END, CASE WHEN {ok} THEN list_append(s.insts, b.i) ELSE s.insts END FROM s JOIN b ON b.n = s.n + 1)
 SELECT image_id, c AS category_code FROM s WHERE image_id IS NOT NULL"""


def _selection(spark, d, inst: int | None):
    norm = lambda c: F.coalesce(F.lower(F.trim(c)), F.lit(""))
    rows = _ranked(spark, d).select("image_id", F.lower(F.trim("category_code")).alias("category_code"), norm("object_id").alias("o"), norm("institution").alias("i"), "h")
    return sampling.greedy_quotas(rows, "category_code", QUOTAS, ["h", "image_id"], "o", 2, "i" if inst else None, inst or 0)


@R.query(_greedy_sql(2, 25))
def greedy_quota_selection(spark, d):
    return _selection(spark, d, 25).select("image_id", "category_code")


@R.query(_greedy_sql(2, None))
def starter_selection(spark, d):
    return _selection(spark, d, None).select("image_id", "category_code")


@R.query("SELECT category_code, quota, selected, quota - selected AS shortfall FROM (SELECT q.category_code, q.quota, count(s.image_id) AS selected FROM (VALUES " + ", ".join(f"('{k}', {v})" for k, v in QUOTAS.items()) + f") q(category_code, quota) LEFT JOIN ({_greedy_sql(2, 25)}) s ON s.category_code = q.category_code GROUP BY 1, 2) WHERE selected < quota")
def selection_shortfalls(spark, d):
    return sampling.shortfalls(_selection(spark, d, 25), "category_code", QUOTAS)


@R.query(f"SELECT doc_id, row_number() OVER (ORDER BY sha256('{SEED}' || CAST(doc_id AS VARCHAR)), doc_id) AS image_id FROM documents")
def stable_ids(spark, d):
    docs = table(spark, d, "documents").select("doc_id", F.sha2(F.concat(F.lit(SEED), F.col("doc_id").cast("string")), 256).alias("h"))
    return sampling.global_rank(docs, ["h", "doc_id"], "image_id").select("doc_id", "image_id")


@R.query(f"SELECT doc_id FROM documents ORDER BY sha256('{SEED}' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 50")
def hash_sample(spark, d):
    return sampling.hash_sample(table(spark, d, "documents").select("doc_id"), SEED, "doc_id", 50)


# --- splits ----------------------------------------------------------------------------------------------------------

_ROWS = f"(SELECT image_id, lower(trim(object_id)) AS object_id, lower(trim(category_code)) AS category_code FROM {META})"
_PRIME = f"(SELECT object_id, arg_min(category_code, {{'m': -n, 'c': category_code}}) AS category_code, CAST(sum(n) AS BIGINT) AS size FROM (SELECT object_id, coalesce(category_code, '') AS category_code, count(*) AS n FROM {_ROWS} GROUP BY 1, 2) GROUP BY 1)"


def _object_rows(spark, d):
    return meta(spark, d).select("image_id", F.lower(F.trim("object_id")).alias("object_id"), F.lower(F.trim("category_code")).alias("category_code"))


@R.query(f"SELECT object_id, category_code, size FROM {_PRIME}")
def primary_category(spark, d):
    return splitting.primary_category(_object_rows(spark, d), "object_id", "category_code")


@R.query(f"""WITH RECURSIVE o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY category_code ORDER BY sha256('{SEED}:' || category_code || ':' || object_id)) AS i, sum(size) OVER (PARTITION BY category_code) AS t FROM {_PRIME}),
 s(category_code, i, object_id, size, split, a, b, c) AS (
  SELECT category_code, CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS BIGINT), CAST(NULL AS VARCHAR), CAST(0 AS HUGEINT), CAST(0 AS HUGEINT), CAST(0 AS HUGEINT) FROM (SELECT DISTINCT category_code FROM o)
  UNION ALL SELECT category_code, i, object_id, size, k, a + CASE k WHEN 'train' THEN size ELSE 0 END, b + CASE k WHEN 'validation' THEN size ELSE 0 END, c + CASE k WHEN 'test' THEN size ELSE 0 END FROM (
   SELECT o.category_code, o.i, o.object_id, o.size, s.a, s.b, s.c, CASE WHEN 0.8::DOUBLE * t - s.a >= 0.1::DOUBLE * t - s.b AND 0.8::DOUBLE * t - s.a >= 0.1::DOUBLE * t - s.c THEN 'train' WHEN 0.1::DOUBLE * t - s.b >= 0.1::DOUBLE * t - s.c THEN 'validation' ELSE 'test' END AS k
   FROM s JOIN o ON o.category_code = s.category_code AND o.i = s.i + 1))
 SELECT object_id, category_code, size, split FROM s WHERE i > 0""")
def object_splits(spark, d):
    return splitting.assign_object_splits(_object_rows(spark, d), "object_id", "category_code", SEED)


_SPLITS = "(SELECT DISTINCT image_id, lower(trim(object_id)) AS object_id, lower(trim(category_code)) AS category_code, lower(trim(split)) AS split FROM splits)"


def _split_rows(spark, d):
    return table(spark, d, "splits").select("image_id", *[F.lower(F.trim(c)).alias(c) for c in ("object_id", "category_code", "split")]).distinct()


@R.query(f"SELECT split, count(*) AS \"rows\", count(DISTINCT object_id) AS objects FROM {_SPLITS} GROUP BY 1")
def split_counts(spark, d):
    return splitting.split_counts(_split_rows(spark, d))


@R.query(f"SELECT category_code, count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation, count(*) FILTER (split = 'test') AS test FROM {_SPLITS} GROUP BY 1")
def split_crosstab(spark, d):
    return splitting.split_crosstab(_split_rows(spark, d), "category_code")


@R.query(f"""WITH p AS (SELECT object_id, bool_or(split = 'train') AS t, bool_or(split = 'validation') AS v, bool_or(split = 'test') AS e FROM {_SPLITS} GROUP BY 1)
 SELECT 'train' AS a, 'validation' AS b, count(*) FILTER (t AND v) AS objects FROM p UNION ALL SELECT 'train', 'test', count(*) FILTER (t AND e) FROM p UNION ALL SELECT 'validation', 'test', count(*) FILTER (v AND e) FROM p
 UNION ALL SELECT 'any', 'any', max(t::INT + v::INT + e::INT) FROM p""")
def split_leakage(spark, d):
    return splitting.leakage(_split_rows(spark, d))


# --- release ---------------------------------------------------------------------------------------------------------

_LOG = "(SELECT DISTINCT image_id, status, attempts, logged_at FROM download_log)"
_LATEST = f"(SELECT image_id, arg_max({{'s': status, 'a': attempts}}, {{'t': logged_at, 'a': attempts, 's': status}}) AS r FROM {_LOG} WHERE logged_at IS NOT NULL AND attempts IS NOT NULL AND status IS NOT NULL AND image_id IS NOT NULL GROUP BY 1)"


def _log(spark, d):
    return table(spark, d, "download_log").select("image_id", "status", "attempts", "logged_at").where("logged_at IS NOT NULL AND attempts IS NOT NULL AND status IS NOT NULL").distinct()


_ORDER = ["logged_at", "attempts", "status"]


@R.query(f"SELECT image_id, r.s AS status, r.a AS attempts FROM {_LATEST}")
def latest_log_rows(spark, d):
    return release.latest(_log(spark, d), "image_id", _ORDER).select("image_id", "status", "attempts")


@R.query(f"SELECT image_id FROM {META} WHERE image_id NOT IN (SELECT image_id FROM {_LATEST} WHERE r.s = 'success')")
def resume_unresolved(spark, d):
    return release.unresolved(meta(spark, d).select("image_id"), _log(spark, d), "image_id", _ORDER, F.col("status") == "success")


@R.query(f"SELECT coalesce(CASE r.s WHEN 'success' THEN 'complete' ELSE 'failed' END, 'pending') AS state, count(*) AS n FROM (SELECT DISTINCT image_id FROM metadata) m LEFT JOIN (SELECT image_id AS i, r FROM {_LATEST}) l ON l.i = m.image_id GROUP BY l.i IS NULL, 1".replace("coalesce(CASE r.s WHEN 'success' THEN 'complete' ELSE 'failed' END, 'pending') AS state", "CASE WHEN l.i IS NULL THEN 'pending' WHEN r.s = 'success' THEN 'complete' ELSE 'failed' END AS state").replace("GROUP BY l.i IS NULL, 1", "GROUP BY 1"))
def completion_states(spark, d):
    return release.completion(table(spark, d, "metadata"), _log(spark, d), "image_id", _ORDER, F.col("status") == "success")


_JOINED = f"(SELECT m.image_id, l.r.s AS status, s.split FROM {META} m LEFT JOIN {_LATEST} l ON l.image_id = m.image_id LEFT JOIN (SELECT DISTINCT image_id, lower(trim(split)) AS split FROM splits) s ON s.image_id = m.image_id)"


def _gated(spark, d):
    log = release.latest(_log(spark, d), "image_id", _ORDER).select("image_id", "status")
    gates = [("NOT_FETCHED", F.col("status") == "success"), ("NO_SPLIT", F.col("split").isNotNull())]
    return release.gated_join(meta(spark, d).select("image_id"), [("log", log), ("splits", _split_rows(spark, d).select("image_id", "split"))], "image_id", gates)


@R.query(f"SELECT image_id, split FROM {_JOINED} WHERE status = 'success' AND split IS NOT NULL")
def release_rows(spark, d):
    return _gated(spark, d)[0].select("image_id", "split")


@R.query(f"SELECT CASE WHEN status IS DISTINCT FROM 'success' THEN 'NOT_FETCHED' ELSE 'NO_SPLIT' END AS reason, count(*) AS n FROM {_JOINED} WHERE status IS DISTINCT FROM 'success' OR split IS NULL GROUP BY 1")
def excluded_reasons(spark, d):
    return _gated(spark, d)[1]


@R.query("SELECT 'reuse' AS part, count(*) AS n FROM (SELECT DISTINCT * FROM metadata) m WHERE EXISTS (FROM download_log l WHERE coalesce(l.object_id, '') = coalesce(m.object_id, '') AND coalesce(l.media_id, '') = coalesce(m.media_id, '')) UNION ALL SELECT 'fetch', count(*) FROM (SELECT DISTINCT * FROM metadata) m WHERE NOT EXISTS (FROM download_log l WHERE coalesce(l.object_id, '') = coalesce(m.object_id, '') AND coalesce(l.media_id, '') = coalesce(m.media_id, ''))")
def reuse_counts(spark, d):
    old, new = release.reuse_split(meta(spark, d).select("image_id", "object_id", "media_id"), table(spark, d, "download_log"), ["object_id", "media_id"])
    return old.agg(F.count("*").alias("n")).select(F.lit("reuse").alias("part"), "n").unionByName(new.agg(F.count("*").alias("n")).select(F.lit("fetch").alias("part"), "n"))


@R.query("SELECT coalesce(CAST(image_id AS VARCHAR), '') AS image_id FROM (SELECT DISTINCT image_id FROM splits WHERE image_id NOT IN (SELECT image_id FROM metadata))")
def subset_check(spark, d):
    return release.not_subset(table(spark, d, "splits"), table(spark, d, "metadata"), ["image_id"]).select(F.col("_k0").alias("image_id"))


@R.query("SELECT 'left_only' AS side, count(*) AS n FROM (SELECT image_id FROM metadata EXCEPT SELECT image_id FROM splits) UNION ALL SELECT 'right_only', count(*) FROM (SELECT image_id FROM splits EXCEPT SELECT image_id FROM metadata)")
def set_equality(spark, d):
    return release.set_difference(table(spark, d, "metadata"), table(spark, d, "splits"), "image_id")


@R.query(f"SELECT image_id FROM (SELECT image_id, lower(trim(object_id)) AS a, true AS x FROM {META}) FULL JOIN (SELECT image_id, object_id AS b, true AS y FROM {_SPLITS}) USING (image_id) WHERE a IS DISTINCT FROM b OR x IS NULL OR y IS NULL")
def sequence_differences(spark, d):
    ours = meta(spark, d).select("image_id", F.lower(F.trim("object_id")).alias("object_id"))
    return release.sequence_differences(ours, _split_rows(spark, d), "image_id", ["object_id"])


@R.query("SELECT sha256(text) || '  texts/' || CAST(doc_id AS VARCHAR) || '.txt' AS value FROM documents WHERE text IS NOT NULL")
def checksum_manifest(spark, d):
    sums = table(spark, d, "documents").where("text IS NOT NULL").select(F.concat(F.lit("texts/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), F.sha2("text", 256).alias("sha256"))
    return release.checksum_lines(sums)


@R.query("SELECT 'texts/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, CASE WHEN lang IS NULL THEN 'missing' WHEN text <> replace(text, '&amp;', '&') THEN 'mismatch' ELSE 'ok' END AS verdict FROM documents WHERE text IS NOT NULL")
def checksum_verdicts(spark, d):
    path = F.concat(F.lit("texts/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path")
    docs = table(spark, d, "documents").where("text IS NOT NULL")
    actual = docs.where("lang IS NOT NULL").select(path, F.sha2(F.replace("text", F.lit("&amp;"), F.lit("&")), 256).alias("sha256"))
    return release.verify_checksums(release.checksum_lines(docs.select(path, F.sha2("text", 256).alias("sha256"))), actual)


@R.query(f"""SELECT code, observed, passed FROM (SELECT unnest([
 {{'code': 'DUPLICATE_IMAGE_ID', 'observed': CAST(count(image_id) - count(DISTINCT image_id) AS DOUBLE), 'passed': count(image_id) = count(DISTINCT image_id)}},
 {{'code': 'NON_OPEN_RIGHTS', 'observed': CAST(count(*) FILTER (rights IS DISTINCT FROM 'CC0') AS DOUBLE), 'passed': count(*) FILTER (rights IS DISTINCT FROM 'CC0') = 0}},
 {{'code': 'ROW_COUNT', 'observed': CAST(count(*) AS DOUBLE), 'passed': count(*) BETWEEN 10 AND 1000000000}},
 {{'code': 'TEXT_USABLE_RATIO', 'observed': avg(CASE WHEN {_p('model_text')} THEN 1.0 ELSE 0.0 END), 'passed': avg(CASE WHEN {_p('model_text')} THEN 1.0 ELSE 0.0 END) >= 0.9}}], recursive := true) FROM {META})""")
def validator_report(spark, d):
    checks = [
        validate.Check("DUPLICATE_IMAGE_ID", validate.duplicates("image_id"), most=0),
        validate.Check("NON_OPEN_RIGHTS", validate.violations(F.col("rights") != "CC0"), most=0),
        validate.Check("ROW_COUNT", F.count("*"), 10, 1e9),
        validate.Check("TEXT_USABLE_RATIO", F.avg(X.present("model_text").cast("double")), least=0.9),
    ]
    return validate.run_checks(meta(spark, d), checks)


@R.query("""SELECT 'VECTOR_WIDTH' AS code, CAST(count(*) FILTER (len(embedding) <> 64) AS DOUBLE) AS observed, count(*) FILTER (len(embedding) <> 64) = 0 AS passed FROM embeddings UNION ALL SELECT 'VECTOR_NOT_FINITE', 0.0, true
 UNION ALL SELECT 'VECTOR_NORM', round(max(abs(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) - 1)), 5), max(abs(sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) - 1)) <= 0.01 FROM embeddings""")
def vector_report(spark, d):
    return validate.run_checks(table(spark, d, "embeddings"), validate.vector_checks("embedding", 64)).withColumn("observed", F.round("observed", 5))


# --- vectors ---------------------------------------------------------------------------------------------------------

_UNIT = "(SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v, sqrt(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE))) AS n FROM embeddings)"


@R.query(f"SELECT vec_id, round(n, 5) AS norm, round(list_sum(v) / n, 4) AS total FROM {_UNIT}")
def l2_normalized(spark, d):
    e = table(spark, d, "embeddings").select("vec_id", V.norm("embedding").alias("n"), V.l2_normalize("embedding").alias("v"))
    return e.select("vec_id", F.round("n", 5).alias("norm"), F.round(F.aggregate("v", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@R.query(f"SELECT count(*) AS n, round(min(n), 5) AS least, round(max(n), 5) AS most, round(avg(n), 5) AS mean, CAST(0 AS BIGINT) AS not_finite FROM {_UNIT}")
def norm_report(spark, d):
    return search.norm_report(table(spark, d, "embeddings")).select("n", F.round("least", 5).alias("least"), F.round("most", 5).alias("most"), F.round("mean", 5).alias("mean"), "not_finite")


def _query_vector(spark, d):
    return table(spark, d, "embeddings").where("vec_id = 7").first()["embedding"]


_COS = f"(SELECT x.vec_id, x.label, list_dot_product(x.v, q.v) / (x.n * q.n) AS score FROM {_UNIT} x, (SELECT v, n FROM {_UNIT} WHERE vec_id = 7) q)"


@R.query(f"""SELECT query_id, vec_id, round(score, 6) AS score FROM (SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(x.v, q.v) / (x.n * q.n) AS score, row_number() OVER (PARTITION BY q.vec_id ORDER BY list_dot_product(x.v, q.v) / (x.n * q.n) DESC, x.vec_id) AS r
 FROM {_UNIT} x, {_UNIT} q WHERE q.vec_id % 50 = 0) WHERE r <= 10""")
def cosine_top_k(spark, d):
    e = table(spark, d, "embeddings")
    return search.top_k_many(e, e.where("vec_id % 50 = 0"), 10).select("query_id", "vec_id", F.round("score", 6).alias("score"))


#: Vectors with one such key show one object.
_OBJECT = "vec_id // 5"


@R.query(f"""WITH RECURSIVE c AS MATERIALIZED (SELECT vec_id, label, {_OBJECT} AS o, score FROM {_COS}), n AS (SELECT label, row_number() OVER (ORDER BY label) AS k FROM (SELECT DISTINCT label FROM c WHERE label IS NOT NULL)),
 s(k, label, vec_id, used) AS (SELECT CAST(0 AS BIGINT), CAST(NULL AS INTEGER), CAST(NULL AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL SELECT k, label, r.v, CASE WHEN r IS NULL THEN used ELSE list_append(used, r.o) END FROM (SELECT s.k + 1 AS k, n.label, s.used, arg_min({{'v': c.vec_id, 'o': c.o}}, {{'s': -c.score, 'v': c.vec_id}}) FILTER (NOT list_contains(s.used, c.o)) AS r FROM s JOIN n ON n.k = s.k + 1 JOIN c ON c.label = n.label GROUP BY 1, 2, 3))
 SELECT label, vec_id FROM s WHERE vec_id IS NOT NULL""")
def best_per_label(spark, d):
    e = table(spark, d, "embeddings")
    q = V.l2_normalize(F.array(*[F.lit(float(x)) for x in _query_vector(spark, d)]))
    scored = e.select("vec_id", "label", V.dot(V.l2_normalize("embedding"), q).alias("score"), F.expr("vec_id div 5").alias("object"))
    labels = [r[0] for r in e.where("label IS NOT NULL").select("label").distinct().orderBy("label").limit(10_000).collect()]  # a step for each
    return sampling.best_exclusive(scored, "label", "score", "object", "vec_id", labels).select("label", "vec_id")


# --- nested records --------------------------------------------------------------------------------------------------


@R.query(flat_sql.CANDIDATES)
def flat_candidates(spark, d):
    return flatten.candidates(table(spark, d, "source_records"), host=HOST)


@R.query(flat_sql.identified(SEED))
def identified_candidates(spark, d):
    flat = flatten.candidates(table(spark, d, "source_records"), host=HOST).dropDuplicates(["object_id", "media_id", "media_url"])
    return flatten.identify(flat, SEED).select("image_id", "file_name", "selection_hash", "object_id", "media_id", "media_url")


@R.query(f"SELECT line_id FROM source_records WHERE line_id IN (SELECT line_id FROM ({flat_sql.CANDIDATES}))")
def preserved_lines(spark, d):
    records = table(spark, d, "source_records")
    return records.join(flatten.candidates(records).select("line_id").distinct(), "line_id", "left_semi").select("line_id")


@R.query(f"SELECT CAST(to_json({{'source_unit': source_unit, 'source_shard_url': source_shard_url, 'record': record_json}}) AS VARCHAR) AS value FROM source_records WHERE line_id IN (SELECT line_id FROM ({flat_sql.CANDIDATES}))")
def preserved_records(spark, d):
    records = table(spark, d, "source_records")
    return flatten.preserved_records(records, flatten.candidates(records))


# --- sources and sinks -----------------------------------------------------------------------------------------------


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@R.query("SELECT l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 45")
def parquet_projection_scan(spark, d):
    return readers.parquet(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_quantity"]).where("l_quantity > 45")


@R.query("SELECT 'all' AS part, count(*) AS n FROM lineitem UNION ALL SELECT v, (SELECT count(*) FROM lineitem WHERE l_returnflag = v) FROM (VALUES ('A'), ('N'), ('R'), ('Z')) t(v)")
def routed_write(spark, d):
    where = writers.routed(table(spark, d, "lineitem"), _folder(spark, "routed"), "l_returnflag", ("A", "N", "R", "Z"))
    out = None
    for part, path in where.items():
        one = spark.read.parquet(path).agg(F.count("*").alias("n")).select(F.lit(part).alias("part"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@R.query("SELECT doc_id, lang, source, text FROM documents")
def ndjson_round_trip(spark, d):
    path = _folder(spark, "ndjson")
    writers.ndjson_gzip(table(spark, d, "documents").select("doc_id", "lang", "source", "text"), path)
    return readers.ndjson(spark, path, "doc_id bigint, lang string, source string, text string")


@R.query("SELECT o_custkey, o_orderkey, o_orderpriority FROM orders")
def csv_round_trip(spark, d):
    path = _folder(spark, "csv")
    writers.csv(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderpriority"), path)
    return spark.read.schema("o_custkey bigint, o_orderkey bigint, o_orderpriority string").option("header", True).csv(path)


@R.query("SELECT source_unit, count(*) AS n FROM source_records WHERE TRY_CAST(record_json AS JSON) IS NOT NULL AND json_valid(record_json) GROUP BY 1")
def ndjson_text_scan(spark, d):
    path = _folder(spark, "shards")
    table(spark, d, "source_records").where("record_json IS NOT NULL").select(F.regexp_replace("record_json", r"[\r\n]", " ").alias("value"), "source_unit").write.partitionBy("source_unit").text(path)
    lines = readers.ndjson_text(spark, path + "/*")
    return lines.groupBy(F.regexp_extract("path", "source_unit=([^/]*)", 1).alias("source_unit")).agg(F.count("*").alias("n"))


# --- streams ---------------------------------------------------------------------------------------------------------


@R.query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_counts(spark, d):
    out, log = _folder(spark, "counts"), _folder(spark, "state")
    stream = jobs.read_folder(spark, f"{d}/event[s].parquet", table(spark, d, "events").schema)
    jobs.run_once(jobs.window_counts(stream, "ts", "1 day", "1 hour", ["event_type"]), lambda b, _: b.write.mode("append").parquet(out), log, "update")
    return spark.read.schema("start timestamp, event_type string, n bigint").parquet(out).groupBy("start", "event_type").agg(F.max("n").alias("n"))


@R.query("SELECT DISTINCT user_id, event_type FROM events")
def stream_first_wins(spark, d):
    out, log = _folder(spark, "first"), _folder(spark, "state")
    stream = jobs.read_folder(spark, f"{d}/event[s].parquet", table(spark, d, "events").schema)
    jobs.run_once(jobs.first_wins(stream, ["user_id", "event_type"], "ts", "3650 days").select("user_id", "event_type"), lambda b, _: b.write.mode("append").parquet(out), log)
    return spark.read.schema("user_id bigint, event_type string").parquet(out)


def _fake(url: str) -> images.Answer:
    return images.Answer(404) if url.endswith("7") else images.Answer(200, "image/jpeg", url.encode())


@R.query(f"""SELECT image_id, CASE WHEN coalesce(image_url, '') = '' OR suffix(image_url, '7') THEN 'failed' ELSE 'success' END AS status, CASE WHEN coalesce(image_url, '') = '' THEN 'MISSING_IMAGE_URL' WHEN suffix(image_url, '7') THEN 'HTTP_404' END AS error,
 CASE WHEN coalesce(image_url, '') <> '' AND NOT suffix(image_url, '7') THEN sha256(image_url) END AS sha256 FROM {META}""")
def fetch_audit(spark, d):
    return images.fetch(meta(spark, d), _fake).select("image_id", "status", "error", "sha256")


def queries() -> dict:
    return dict(R.queries)


def oracle_sql() -> dict[str, str]:
    return dict(R.sql)
