"""Queries of selection, fetch and release audits and their SQL."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from siftwork.functions import text as X
from siftwork.functions import values as V
from siftwork.operators import decide, nested, profile, release, sampling, validate
from siftwork.plans import packed_nested
from siftwork.plans.curation import META, SEED, _folder, _re2_terms, meta
from siftwork.plans.registry import Registry, table
from siftwork.sources import readers, writers
from siftwork.streaming import jobs

R = Registry()

# --- discovery -------------------------------------------------------------------------------------------------------

_POS = f"""(SELECT source_unit, source_shard_url, row_number() OVER (PARTITION BY source_unit ORDER BY sha256('{SEED}:' || upper(source_unit) || ':' || string_split(source_shard_url, '/')[-1]), source_shard_url) - 1 AS shard_pos FROM (SELECT DISTINCT source_unit, source_shard_url FROM source_records))"""
_SCAN = f"""(SELECT line_id, source_unit, shard_pos, CASE WHEN source_unit = (SELECT min(source_unit) FROM source_records) THEN 3 ELSE 20 END AS cap, row_number() OVER (PARTITION BY source_unit ORDER BY shard_pos, source_unit, line_id) AS r FROM source_records JOIN {_POS} USING (source_unit, source_shard_url))"""
_EMITTED = f"(SELECT * FROM {_SCAN} WHERE r <= cap ORDER BY shard_pos, source_unit, line_id LIMIT 150)"


def _scan(spark, d):
    rows = table(spark, d, "source_records").select("line_id", "source_unit", "source_shard_url")
    first = rows.agg(F.min("source_unit")).first()[0]
    pos = sampling.shard_order(rows, SEED, "source_unit", "source_shard_url")
    return sampling.unit_caps(rows.join(pos, ["source_unit", "source_shard_url"]), "source_unit", 20, {first: 3} if first else {"": 1})


_ORDER = ["shard_pos", "source_unit", "line_id"]


@R.query("SELECT CAST(row_number() OVER (ORDER BY source_unit DESC) - 1 AS INT) AS pos, source_unit FROM (SELECT DISTINCT source_unit FROM source_records)")
def requested_units(spark, d):
    units = table(spark, d, "source_records").select("source_unit").distinct()
    asked = [r[0] for r in units.orderBy(F.desc("source_unit")).limit(10_000).collect()]  # a request that names every unit, the first one twice
    return sampling.requested_units([*asked, *asked[:1]], units, "source_unit")


@R.query(f"SELECT DISTINCT source_unit, cap FROM {_SCAN}")
def unit_caps(spark, d):
    return _scan(spark, d).select("source_unit", "cap").distinct()


@R.query(f"SELECT line_id FROM {_EMITTED}")
def capped_round_robin(spark, d):
    return sampling.round_robin_cap(_scan(spark, d), "source_unit", _ORDER, F.col("cap"), 150).select("line_id")


@R.query(f"""SELECT s.source_unit, count(*) AS offered, count(*) FILTER (s.r <= s.cap) AS within_cap, count(e.line_id) AS emitted, count(*) > count(e.line_id) AS truncated FROM {_SCAN} s LEFT JOIN {_EMITTED} e ON e.line_id = s.line_id GROUP BY 1""")
def scan_counters(spark, d):
    return sampling.scan_report(_scan(spark, d), "source_unit", _ORDER, 150)


_HASH = f"sha256('{SEED}:' || coalesce(object_id, '') || '|' || coalesce(media_id, '') || '|' || CAST(image_id AS VARCHAR))"
_PILOT = {"art": 3, "natural_history": 2}


@R.query(f"""SELECT image_id, row_number() OVER (ORDER BY h, image_id) AS pilot_id FROM (SELECT image_id, {_HASH} AS h, category_code, row_number() OVER (PARTITION BY category_code ORDER BY {_HASH}, image_id) AS r FROM {META}) WHERE r <= CASE category_code WHEN 'art' THEN 3 WHEN 'natural_history' THEN 2 ELSE 0 END""")
def pilot_selection(spark, d):
    ranked = meta(spark, d).withColumn("h", V.seeded_sha(SEED, ["object_id", "media_id", "image_id"]))
    return sampling.pilot(ranked.select("image_id", "category_code", "h"), "category_code", _PILOT, ["h", "image_id"]).select("image_id", "pilot_id")


# --- fetch logs ------------------------------------------------------------------------------------------------------

_LATEST = "(SELECT DISTINCT ON (image_id) * FROM download_log WHERE image_id IS NOT NULL ORDER BY image_id, logged_at DESC NULLS LAST, attempts DESC NULLS LAST, status DESC NULLS LAST, file_name DESC NULLS LAST)"


def _latest(spark, d):
    return release.latest(table(spark, d, "download_log").select("image_id", "file_name", "status", "attempts", "logged_at"), "image_id", ["logged_at", "attempts", "status"])


@R.query(f"SELECT image_id, status FROM {_LATEST}")
def latest_attempts(spark, d):
    """Over all rows of the log; those without a time come before all others."""
    return _latest(spark, d).select("image_id", "status")


@R.query(f"""SELECT DISTINCT l.image_id FROM {_LATEST} l JOIN (SELECT image_id, final_bytes FROM {META}) m ON m.image_id = l.image_id JOIN (SELECT file_name, CASE WHEN width >= height THEN final_bytes ELSE final_bytes + 1 END AS n FROM {META} WHERE phash IS NOT NULL) f ON f.file_name = l.file_name
 WHERE l.status = 'success' AND (m.final_bytes IS NULL OR m.final_bytes = f.n)""")
def valid_success(spark, d):
    m = meta(spark, d)
    files = m.where("phash IS NOT NULL").select(F.col("file_name").alias("path"), F.when(F.col("width") >= F.col("height"), F.col("final_bytes")).otherwise(F.col("final_bytes") + 1).alias("length"))
    attempts = _latest(spark, d).join(m.select("image_id", "final_bytes"), "image_id")
    return release.valid_success(attempts, files, F.col("status") == "success").select("image_id")


_CAT = f"(SELECT l.*, m.category_code FROM download_log l LEFT JOIN (SELECT image_id, category_code FROM {META}) m ON m.image_id = l.image_id)"


@R.query(f"""SELECT 'error' AS kind, error AS value, count(*) AS n FROM {_CAT} WHERE error IS NOT NULL GROUP BY 2 UNION ALL SELECT 'http_status', CAST(http_status AS VARCHAR), count(*) FROM {_CAT} WHERE http_status IS NOT NULL GROUP BY 2
 UNION ALL SELECT 'category_code:' || CASE WHEN status = 'success' THEN 'success' ELSE 'failure' END, coalesce(category_code, ''), count(*) FROM {_CAT} GROUP BY 1, 2""")
def fetch_outcomes(spark, d):
    log = table(spark, d, "download_log").join(meta(spark, d).select("image_id", "category_code"), "image_id", "left")
    return profile.outcomes(log, ["error", "http_status"], "category_code", "status", "success")


@R.query(f"""SELECT round(b, 4) AS mean_bytes, round((b * 25000 + 1000000) / 1e9, 9) AS projected_gb, CASE WHEN (b * 25000 + 1000000) / 1e9 <= 1 THEN 'GO' WHEN (b * 25000 + 1000000) / 1e9 <= 2 THEN 'ADJUST' ELSE 'STOP' END AS verdict, round(s * 25000 / 3600 / 8, 6) AS projected_hours
 FROM (SELECT avg(final_bytes) AS b, avg(download_seconds) AS s FROM (SELECT l.download_seconds, m.final_bytes FROM download_log l JOIN (SELECT image_id, final_bytes FROM {META}) m ON m.image_id = l.image_id WHERE l.status = 'success'))""")
def package_hours(spark, d):
    log = table(spark, d, "download_log").join(meta(spark, d).select("image_id", "final_bytes"), "image_id")
    out = profile.package_projection(log, "final_bytes", 25_000, 1_000_000, 1, 2, "status = 'success'", "download_seconds", 8)
    return out.select(F.round("mean_bytes", 4).alias("mean_bytes"), F.round("projected_gb", 9).alias("projected_gb"), "verdict", F.round("projected_hours", 6).alias("projected_hours"))


_SAME = "coalesce(l.object_id, '') = coalesce(m.object_id, '') AND coalesce(l.media_id, '') = coalesce(m.media_id, '')"


@R.query(f"""SELECT CASE WHEN EXISTS (FROM download_log l WHERE {_SAME} AND nullif(lower(trim(l.sha256)), '') = nullif(lower(trim(m.sha256)), '')) THEN 'reuse' WHEN EXISTS (FROM download_log l WHERE {_SAME}) THEN 'mismatch' ELSE 'fetch' END AS verdict, count(*) AS n FROM {META} m GROUP BY 1""")
def verified_reuse(spark, d):
    m = meta(spark, d).select("image_id", "object_id", "media_id", "sha256")
    return release.verified_reuse(m, table(spark, d, "download_log"), ["object_id", "media_id"], "sha256").groupBy("verdict").agg(F.count("*").alias("n"))


@R.query("SELECT file_name FROM metadata WHERE file_name IS NOT NULL EXCEPT SELECT file_name FROM download_log WHERE status = 'success'")
def missing_files(spark, d):
    want = table(spark, d, "metadata").where("file_name IS NOT NULL")
    return release.not_subset(want, table(spark, d, "download_log").where("status = 'success'"), ["file_name"]).select(F.col("_k0").alias("file_name"))


@R.query("SELECT object_id, max(attempts) AS attempts FROM download_log WHERE status = 'success' GROUP BY 1")
def latest_ready(spark, d):
    return release.latest_ready(table(spark, d, "download_log"), "object_id", "attempts", F.col("status") == "success")


# --- release ---------------------------------------------------------------------------------------------------------


@R.query(f"SELECT count(*) AS \"rows\", CAST(sum(coalesce(final_bytes, 0)) AS BIGINT) AS total_bytes, round(sum(coalesce(final_bytes, 0)) / 1e9, 6) AS package_gb FROM {META}")
def release_bytes(spark, d):
    return profile.package_bytes(meta(spark, d), "final_bytes")


_FREQ = ("category_code", "institution", "collection", "object_id")


@R.query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", coalesce({c}, '') AS value, count(*) AS n FROM {META} GROUP BY 2" for c in _FREQ))
def selection_profile(spark, d):
    return profile.frequencies(meta(spark, d), _FREQ)


@R.query("SELECT 'csv' AS part, count(*) AS lines FROM orders UNION ALL SELECT 'jsonl', count(*) FROM customer")
def export_line_counts(spark, d):
    a, b = _folder(spark, "csv"), _folder(spark, "jsonl")
    writers.csv(table(spark, d, "orders").select("o_orderkey", "o_orderpriority"), a)
    writers.jsonl(table(spark, d, "customer"), b, ["c_custkey", "c_name"])
    return readers.line_counts(spark, a, header=True).select(F.lit("csv").alias("part"), "lines").unionByName(readers.line_counts(spark, b).select(F.lit("jsonl").alias("part"), "lines"))


_FILE = "string_split(source_shard_url, '/')[-1]"
_WANT = f"(SELECT DISTINCT {_FILE} AS f FROM source_records WHERE source_unit = (SELECT max(source_unit) FROM source_records))"


@R.query(f"""SELECT source_unit, fetched_at FROM (SELECT source_unit, max(fetched_at) AS fetched_at, list_sort(list(DISTINCT {_FILE})) AS files FROM source_records GROUP BY 1) WHERE files = (SELECT list_sort(list(f)) FROM {_WANT}) ORDER BY fetched_at DESC, source_unit LIMIT 1""")
def matching_resources(spark, d):
    files = table(spark, d, "source_records").select("source_unit", "fetched_at", F.element_at(F.split("source_shard_url", "/"), -1).alias("file"))
    last = files.agg(F.max("source_unit")).first()[0]
    return release.matching_resources(files, files.where(F.col("source_unit") == last), "source_unit", "file", "fetched_at")


_DOCS = [("splits", 0, "image_id", "the image"), ("splits", 1, "split", "where it is"), ("splits", 2, "at", ""), ("events", 0, "ts", "time of the event"), ("events", 1, "value", None)]
_LIVE = [("splits", 0, "image_id", "the image"), ("splits", 1, "split", "its split"), ("events", 0, "ts", "time of the event"), ("events", 1, "value", "a number"), ("events", 2, "props", " ")]
_values = lambda rows: "(VALUES " + ", ".join("(" + ", ".join("NULL" if x is None else repr(x) for x in r) + ")" for r in rows) + ")"


@R.query(f"""SELECT "table", count(*) AS columns, count(*) FILTER (trim(coalesce(v, '')) <> '') AS present, count(*) FILTER (coalesce(d = v, false)) AS exact FROM (SELECT coalesce(a."table", b."table") AS "table", a.d, b.v FROM {_values(_DOCS)} a("table", pos, name, d) FULL JOIN {_values(_LIVE)} b("table", pos, name, v) ON a."table" = b."table" AND a.pos = b.pos) GROUP BY ROLLUP ("table")""")
def described_columns(spark, d):
    shape = "table string, pos int, name string, description string"
    return release.description_coverage(release.described_columns(spark.createDataFrame(_DOCS, shape), spark.createDataFrame(_LIVE, shape)))


@R.query("SELECT image_id, media_rights FROM (SELECT DISTINCT * FROM metadata) WHERE media_rights = 'CC0'")
def required_rights(spark, d):
    open_ = meta(spark, d).where("media_rights = 'CC0'").select("image_id", "media_rights")
    return validate.require(open_, F.col("media_rights") == "CC0", "closed media")


_FIXED = {"image_id": "string", "width": "double", "date": "bigint", "nothing": "string", "objects": "string"}


@R.query(f"SELECT CAST(image_id AS VARCHAR) AS image_id, CAST(width AS DOUBLE) AS width, CASE WHEN regexp_full_match(trim(date), '[0-9]+') THEN TRY_CAST(date AS BIGINT) END AS date, CAST(NULL AS VARCHAR) AS nothing, array_to_string(string_split(object_id, '_'), '|') AS objects FROM {META}")
def fixed_rows(spark, d):
    return decide.fixed_schema(meta(spark, d).withColumn("objects", F.split("object_id", "_")), _FIXED)


# --- terms, labels and vectors ---------------------------------------------------------------------------------------

_NEEDLES = ("gift", "rooms", "of art")


@R.query(f"SELECT DISTINCT collection, coalesce({' OR '.join(f"contains(lower(collection), '{n}')" for n in _NEEDLES)}, false) AS flagged FROM metadata")
def flagged_labels(spark, d):
    return table(spark, d, "metadata").select("collection").distinct().select("collection", X.contains_keyword("collection", _NEEDLES).alias("flagged"))


_RIGHTS, _TERMS, _MORE = ("permission", "restricted"), ("fire", "horn", "c. 1664"), ("portrait", "drawing")


@R.query(f"""SELECT image_id, regexp_matches(lower(concat_ws(' ', object_rights, rights)), '{_re2_terms(_RIGHTS)}') AS rights_context,
 (coalesce(upper(trim(unit_code)) = u, false) OR regexp_matches(h, '{_re2_terms(_TERMS)}') OR (coalesce(upper(trim(unit_code)) = v, false) AND regexp_matches(h, '{_re2_terms(_MORE)}'))) AS sensitive
 FROM (SELECT *, lower(concat_ws(' ', title, description, media_caption, alt_text)) AS h, (SELECT min(upper(trim(unit_code))) FROM metadata) AS u, (SELECT max(upper(trim(unit_code))) FROM metadata) AS v FROM {META})""")
def context_flags(spark, d):
    """Terms of the rights' context; units and terms that ask for a look, with further terms in some units."""
    m = meta(spark, d)
    unit = F.upper(F.trim("unit_code"))
    low, high = m.agg(F.min(unit), F.max(unit)).first()
    hay = F.concat_ws(" ", "title", "description", "media_caption", "alt_text")
    listed, more = F.coalesce(unit == low, F.lit(False)), F.coalesce(unit == high, F.lit(False))
    return m.select("image_id", X.contains_term(F.concat_ws(" ", "object_rights", "rights"), _RIGHTS).alias("rights_context"), (listed | X.contains_term(hay, _TERMS) | (more & X.contains_term(hay, _MORE))).alias("sensitive"))


@R.query(f"""SELECT "group", label, n FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY n DESC, label) AS r FROM (SELECT split_part(name, '.', 2) AS "group", CASE WHEN trim(coalesce(l, '')) = '' THEN '<missing>' ELSE trim(l) END AS label, count(*) AS n
 FROM ({packed_nested.FREETEXT_LABELS}) GROUP BY 1, 2)) WHERE r <= 30""")
def label_profile(spark, d):
    items = nested.explode_levels(table(spark, d, "source_records"), levels=nested.RECORD_LEVELS[:1])
    return profile.label_frequencies(items.withColumn("group", F.regexp_extract("item_path", r"^[^.]+\.(.*)\[\d+\]$", 1)), "group", "label")


@R.query(f"SELECT e.vec_id, e.label, m.title, m.aspect_ratio FROM embeddings e JOIN {META} m ON m.image_id = e.vec_id WHERE m.aspect_ratio BETWEEN 0.65 AND 1.8")
def vectors_with_metadata(spark, d):
    shown = meta(spark, d).where(F.col("aspect_ratio").between(0.65, 1.8)).select(F.col("image_id").alias("vec_id"), "title", "aspect_ratio")
    return table(spark, d, "embeddings").select("vec_id", "label").join(shown, "vec_id")


@R.query(f"SELECT CASE category_code WHEN 'art' THEN 'Art' WHEN 'natural_history' THEN 'Nature' ELSE 'Other' END AS label, count(*) AS n FROM {META} GROUP BY 1")
def configured_labels(spark, d):
    path = _folder(spark, "config") + ".json"
    writers.lines(spark.createDataFrame([(json.dumps({"labels": {"art": "Art", "natural_history": "Nature"}, "default": "Other"}),)], "value string"), path)
    rules = readers.config(spark, path)
    label = decide.decision_list([(F.col("category_code") == k, v) for k, v in rules["labels"].items()], rules["default"])
    return meta(spark, d).groupBy(label.alias("label")).agg(F.count("*").alias("n"))


# --- passes ----------------------------------------------------------------------------------------------------------


@R.query("SELECT count(*) AS \"rows\", count(*) FILTER (event_type = 'error') AS errors, max(event_id) AS last FROM events")
def observed_counts(spark, d):
    got = jobs.observed(table(spark, d, "events"), lambda df: writers.zstd_parquet(df, _folder(spark, "events")), rows=F.count("*"), errors=F.count_if(F.col("event_type") == "error"), last=F.max("event_id"))
    return spark.createDataFrame([(got["rows"], got["errors"], got["last"])], "rows bigint, errors bigint, last bigint")


@R.query("SELECT 'nation' AS name, count(*) AS n FROM nation UNION ALL SELECT 'supplier', count(*) FROM supplier")
def promoted_tables(spark, d):
    where = writers.promote({n: table(spark, d, n) for n in ("nation", "supplier")}, _folder(spark, "set"))
    parts = [spark.read.parquet(p).agg(F.count("*").alias("n")).select(F.lit(n).alias("name"), "n") for n, p in where.items()]
    return parts[0].unionByName(parts[1])


def queries() -> dict:
    return dict(R.queries)


def oracle_sql() -> dict[str, str]:
    return dict(R.sql)
