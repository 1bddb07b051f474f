"""Queries of packed fields and nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.operators import nested, packed


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return packed.split_packed(spark.read.parquet(f"{d}/metadata.parquet"), min_terms=2)


def p1_terms(spark: SparkSession, d: str) -> DataFrame:
    return packed.split_packed(spark.read.parquet(f"{d}/metadata.parquet"))


#: The child tables of a museum record.
TABLES = ("freetext", "indexed_terms", "media", "resources")


def _children(spark: SparkSession, d: str) -> DataFrame:
    records = spark.read.parquet(f"{d}/source_records.parquet")
    levels, _ = nested.infer_levels(records)
    return nested.explode_levels(records, levels=levels).where(F.col("table").isin(*TABLES))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return _children(spark, d).select("line_id", "item_path")


def p5_links(spark: SparkSession, d: str) -> DataFrame:
    return _children(spark, d).select("line_id", "table", "item_path", "parent_path", "ordinal")


def p5_record_fields(spark: SparkSession, d: str) -> DataFrame:
    return p5_records(spark, d).select("line_id", "record_id", "unit_code", "title", "type", "object_id", "data_source", "metadata_access")


def p5_schema(spark: SparkSession, d: str) -> DataFrame:
    return nested.infer_schema(spark.read.parquet(f"{d}/source_records.parquet"))


def p5_media(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_tables(spark.read.parquet(f"{d}/source_records.parquet"))["media"]


def p5_resources(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_tables(spark.read.parquet(f"{d}/source_records.parquet"))["resources"]


def p5_records(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_tables(spark.read.parquet(f"{d}/source_records.parquet"))["records"]


def p5_freetext(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_tables(spark.read.parquet(f"{d}/source_records.parquet"))["freetext"]


def p5_indexed_terms(spark: SparkSession, d: str) -> DataFrame:
    return nested.flat_tables(spark.read.parquet(f"{d}/source_records.parquet"))["indexed_terms"]


def queries() -> dict:
    return {f.__name__: f for f in (p1_found, p1_terms, p5_found, p5_links, p5_schema, p5_record_fields, p5_records, p5_freetext, p5_indexed_terms, p5_media, p5_resources)}


# An object stored as JSON text counts as the object; an object or scalar in place of an array as its element 0.
_OBJ = "CASE WHEN json_type({x}) = 'VARCHAR' AND starts_with(ltrim({x} ->> '$'), '{{') AND json_valid({x} ->> '$') THEN CAST({x} ->> '$' AS JSON) ELSE {x} END"
_ARR = "CASE WHEN {x} IS NULL OR json_type({x}) = 'NULL' THEN [] WHEN json_type({x}) = 'ARRAY' THEN CAST({x} AS JSON[]) ELSE [{x}] END"


def _obj(x: str) -> str:
    return _OBJ.format(x=f"({x})")


def _groups(root: str, shown: str) -> str:
    return f"""SELECT line_id, '{shown}.' || k AS name, {_ARR.format(x=f"(o -> ('$.\"' || k || '\"'))")} AS items FROM (SELECT line_id, o, unnest(json_keys(o)) AS k FROM (SELECT line_id, {_obj(root)} AS o FROM r) WHERE json_type(o) = 'OBJECT')"""


_RECORDS = f"""v AS (SELECT line_id, CAST(record_json AS JSON) AS j FROM source_records WHERE json_valid(record_json)),
 w AS (SELECT line_id, CASE WHEN (j -> '$.content') IS NULL AND json_type({_obj("j -> '$.record'")}) = 'OBJECT' THEN {_obj("j -> '$.record'")} ELSE j END AS j FROM v),
 r AS (SELECT line_id, {_obj("j -> '$.content'")} AS c FROM w),
 n AS (SELECT line_id, {_obj("c -> '$.descriptiveNonRepeating'")} AS x FROM r)"""
_LINKS = f"""WITH {_RECORDS},
 m AS (SELECT line_id, {_obj("x -> '$.online_media'")} AS x FROM n),
 a AS ({_groups("c -> '$.freetext'", "freetext")} UNION ALL {_groups("c -> '$.indexedStructured'", "indexedStructured")}
   UNION ALL SELECT line_id, 'online_media.media', {_ARR.format(x="(x -> '$.media')")} FROM m),
 e AS (SELECT line_id, name, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS i FROM a),
 p AS (SELECT line_id, name, name || '[' || i || ']' AS item_path, i, {_obj("item")} AS item FROM e WHERE item IS NOT NULL AND json_type(item) <> 'NULL'),
 q AS (SELECT line_id, item_path AS parent_path, item_path || '.resources' AS name, {_ARR.format(x="(item -> '$.resources')")} AS items FROM p WHERE name = 'online_media.media' AND json_type(item) = 'OBJECT'),
 s AS (SELECT line_id, parent_path, name, unnest(items) AS item, generate_subscripts(items, 1) - 1 AS i FROM q)
 SELECT line_id, CASE WHEN starts_with(name, 'freetext') THEN 'freetext' WHEN starts_with(name, 'indexed') THEN 'indexed_terms' ELSE 'media' END AS "table", item_path, '' AS parent_path, CAST(i AS INT) AS ordinal FROM p
 UNION ALL SELECT line_id, 'resources', name || '[' || i || ']', parent_path, CAST(i AS INT) FROM s WHERE item IS NOT NULL AND json_type(item) <> 'NULL'"""


def _scalar(x: str) -> str:
    return f"CASE WHEN json_type({_obj(x)}) IN ('OBJECT', 'ARRAY', 'NULL') THEN NULL ELSE ({x}) ->> '$' END"


FREETEXT_LABELS = f"""WITH {_RECORDS}, a AS ({_groups("c -> '$.freetext'", "freetext")}), e AS (SELECT name, {_obj("item")} AS item FROM (SELECT name, unnest(items) AS item FROM a))
 SELECT name, CASE WHEN json_type(item) = 'OBJECT' THEN item ->> '$.label' END AS l FROM e WHERE item IS NOT NULL AND json_type(item) <> 'NULL'"""

_FIELDS = f"""WITH {_RECORDS}
 SELECT line_id, {_scalar("j -> '$.id'")} AS record_id, {_scalar("j -> '$.unitCode'")} AS unit_code, {_scalar("j -> '$.title'")} AS title, {_scalar("j -> '$.type'")} AS type,
  {_scalar("x -> '$.record_ID'")} AS object_id, {_scalar("x -> '$.data_source'")} AS data_source, {_scalar(_obj("x -> '$.metadata_usage'") + " -> '$.access'")} AS metadata_access
 FROM w JOIN n USING (line_id) WHERE json_type(j) = 'OBJECT'"""

_SCHEMA = f"""WITH RECURSIVE {_RECORDS},
 t(path, v) AS (SELECT '$', j FROM w WHERE json_type(j) = 'OBJECT' UNION ALL SELECT path || c.k, {_obj("c.v")} FROM (SELECT path, unnest(CASE json_type(v)
   WHEN 'OBJECT' THEN list_transform(json_keys(v), lambda k: {{'k': '.' || k, 'v': v -> ('$."' || k || '"')}}) WHEN 'ARRAY' THEN list_transform(CAST(v AS JSON[]), lambda e: {{'k': '[]', 'v': e}}) END) AS c FROM t WHERE json_type(v) IN ('OBJECT', 'ARRAY')))
 SELECT path, CASE coalesce(json_type(v), 'NULL') WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'NULL' THEN 'null' WHEN 'BOOLEAN' THEN 'boolean' ELSE 'number' END AS kind, count(*) AS n FROM t GROUP BY 1, 2
 UNION ALL SELECT '!broken', 'string', n FROM (SELECT count(*) AS n FROM source_records LEFT JOIN w USING (line_id) WHERE record_json IS NOT NULL AND json_type(j) IS DISTINCT FROM 'OBJECT') WHERE n > 0"""


def oracle_sql() -> dict[str, str]:
    return {"p5_found": f"SELECT line_id, item_path FROM ({_LINKS})", "p5_links": _LINKS, "p5_record_fields": _FIELDS, "p5_schema": _SCHEMA}
