"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.llm import chunks, cross_split, leakage, mixing, quota_sample, related_splits

Query = Callable[[SparkSession, str], DataFrame]


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.unmet(_t(spark, d, "metadata"), _t(spark, d, "sample_targets"))


def p2_report(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.draw(_t(spark, d, "metadata"), _t(spark, d, "sample_targets"), with_rows=False)[0]


def p2_sample(spark: SparkSession, d: str) -> DataFrame:
    return quota_sample.draw(_t(spark, d, "metadata"), _t(spark, d, "sample_targets"))[1]


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return related_splits.spanning_groups(_t(spark, d, "metadata"))


def p3_splits(spark: SparkSession, d: str) -> DataFrame:
    return related_splits.assign_splits(_t(spark, d, "metadata"))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return related_splits.split_report(related_splits.assign_splits(_t(spark, d, "metadata")))


def p3_labels(spark: SparkSession, d: str) -> DataFrame:
    return related_splits.label_report(related_splits.assign_splits(_t(spark, d, "metadata")))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    _, pairs = cross_split.overlaps(_t(spark, d, "metadata"), _t(spark, d, "splits"))
    return pairs.select(F.least("train_id", "eval_id").alias("image_id_a"), F.greatest("train_id", "eval_id").alias("image_id_b"))


def p4_coverage(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.evaluation_coverage(_t(spark, d, "metadata"), _t(spark, d, "splits"))


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return cross_split.overlap_report(_t(spark, d, "metadata"), _t(spark, d, "splits"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_pairs(_t(spark, d, "documents"), _t(spark, d, "eval_items"))


def p6_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaks(_t(spark, d, "documents"), _t(spark, d, "eval_items"))


def p6_edited(spark: SparkSession, d: str) -> DataFrame:
    return leakage.edited_copies(_t(spark, d, "documents"), _t(spark, d, "eval_items"))


def p6_items(spark: SparkSession, d: str) -> DataFrame:
    return leakage.leaked_items(_t(spark, d, "documents"), _t(spark, d, "eval_items"))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return mixing.unreachable(_t(spark, d, "documents"), _t(spark, d, "mix_targets"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.draw_mix(_t(spark, d, "documents"), _t(spark, d, "mix_targets"))[1]


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mix_report(_t(spark, d, "documents"), _t(spark, d, "mix_targets"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return chunks.oversized(_t(spark, d, "documents"))


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    return chunks.split_oversized(_t(spark, d, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p2_found, p2_report, p2_sample, p3_found, p3_splits, p3_report, p3_labels, p4_found, p4_coverage, p4_report, p6_found, p6_leaks, p6_edited, p6_items, p7_found, p7_mix, p7_report, p8_found, p8_pieces)}


_META = """(SELECT image_id, any_value(nullif(lower(trim(object_id)), '')) AS o, any_value(CASE WHEN regexp_matches(media_id, '[0-9]') THEN lower(trim(media_id)) END) AS m, any_value(nullif(lower(trim(sha256)), '')) AS s,
 any_value(CASE WHEN regexp_full_match(lower(trim(phash)), '[0-9a-f]{16}') THEN CAST('0x' || lower(trim(phash)) AS UBIGINT) END) AS h, any_value(nullif(lower(trim(category_code)), '')) AS category_code,
 any_value(nullif(lower(trim(institution)), '')) AS institution, any_value(nullif(lower(trim(unit_code)), '')) AS unit_code FROM metadata WHERE image_id IS NOT NULL GROUP BY 1)"""

_P2 = f"""SELECT t.target_id FROM sample_targets t LEFT JOIN (SELECT 'category_code' AS f, category_code AS c, count(*) AS n FROM {_META} GROUP BY 2 UNION ALL SELECT 'institution', institution, count(*) FROM {_META} GROUP BY 2
 UNION ALL SELECT 'unit_code', unit_code, count(*) FROM {_META} GROUP BY 2) k ON k.f = t.field_name AND k.c = lower(trim(t.category)) WHERE coalesce(k.n, 0) < greatest(coalesce(t.min_rows, 0), t.target_share * t.sample_rows)"""

_P2_REPORT = f"""WITH k AS (SELECT 'category_code' AS f, category_code AS c, count(*) AS n FROM {_META} GROUP BY 2 UNION ALL SELECT 'institution', institution, count(*) FROM {_META} GROUP BY 2 UNION ALL SELECT 'unit_code', unit_code, count(*) FROM {_META} GROUP BY 2),
 t AS (SELECT *, target_share * sample_rows AS e, floor(target_share * sample_rows) AS b FROM sample_targets),
 q AS (SELECT *, row_number() OVER (PARTITION BY plan_name ORDER BY e - b DESC, target_id) <= round_even(sum(e) OVER (PARTITION BY plan_name), 0) - sum(b) OVER (PARTITION BY plan_name) AS up FROM t),
 w AS (SELECT target_id, plan_name, field_name, coalesce(nullif(lower(trim(category)), ''), '') AS category, target_share, greatest(coalesce(min_rows, 0), e) AS needed, CAST(greatest(b + CAST(up AS INT), coalesce(min_rows, 0)) AS BIGINT) AS quota FROM q)
 SELECT target_id, plan_name, field_name, category, target_share, needed, coalesce(n, 0) AS available, quota, least(quota, coalesce(n, 0)) AS drawn, greatest(0, CAST(ceil(needed) AS BIGINT) - coalesce(n, 0)) AS shortfall, coalesce(n, 0) >= needed AS met FROM w LEFT JOIN k ON k.f = field_name AND k.c = category"""

_P3 = f"""WITH RECURSIVE b AS MATERIALIZED (SELECT image_id, coalesce(o, '#' || image_id) AS o, m FROM {_META}),
 e AS MATERIALIZED (SELECT DISTINCT x.o AS a, y.o AS b FROM b x JOIN b y ON x.m = y.m AND x.o <> y.o),
 r(node, root) AS (SELECT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
 g AS (SELECT node, min(root) AS root FROM r GROUP BY 1)
 SELECT min(image_id) OVER (PARTITION BY root) AS group_image_id, image_id FROM b JOIN g ON g.node = b.o"""

_P4 = f"""WITH j AS MATERIALIZED (SELECT x.*, sp FROM {_META} x JOIN (SELECT image_id, any_value(lower(trim(split))) AS sp FROM splits GROUP BY 1) y ON y.image_id = x.image_id)
 SELECT DISTINCT least(t.image_id, e.image_id) AS image_id_a, greatest(t.image_id, e.image_id) AS image_id_b FROM j t JOIN j e ON t.sp = 'train' AND e.sp IN ('validation', 'test') AND (t.s = e.s OR t.o = e.o OR bit_count(xor(t.h, e.h)) <= 4)"""


_P4_REPORT = f"""WITH j AS MATERIALIZED (SELECT x.*, sp FROM {_META} x JOIN (SELECT image_id, any_value(lower(trim(split))) AS sp FROM splits GROUP BY 1) y ON y.image_id = x.image_id),
 p AS (SELECT e.image_id AS i, count(DISTINCT t.image_id) AS n FROM j t JOIN j e ON t.sp = 'train' AND e.sp IN ('validation', 'test') AND (t.s = e.s OR t.o = e.o OR bit_count(xor(t.h, e.h)) <= 4) GROUP BY 1)
 SELECT sp AS split, coalesce(institution, '') AS institution, count(*) AS records, count(n) AS overlapping, CAST(coalesce(sum(n), 0) AS BIGINT) AS pairs FROM j LEFT JOIN p ON p.i = j.image_id WHERE sp IN ('validation', 'test') GROUP BY 1, 2"""


_DIGITS = "list_sum(list_transform(range(16), lambda i: CASE WHEN ((xor(t.h, e.h) >> (4 * i)) & 15) = 0 THEN 1 << i ELSE 0 END))"
_P4_COVERAGE = f"""WITH j AS MATERIALIZED (SELECT x.*, sp FROM {_META} x JOIN (SELECT image_id, any_value(lower(trim(split))) AS sp FROM splits GROUP BY 1) y ON y.image_id = x.image_id),
 p AS (SELECT e.image_id AS i, count(*) AS n, bool_or(coalesce(t.s = e.s, false)) AS s, bool_or(coalesce(t.o = e.o, false)) AS o, bool_or(coalesce(bit_count(xor(t.h, e.h)) <= 4, false)) AS p, bit_or(CASE WHEN bit_count(xor(t.h, e.h)) <= 4 THEN CAST({_DIGITS} AS INTEGER) ELSE 0 END) AS d
  FROM j t JOIN j e ON t.sp = 'train' AND e.sp IN ('validation', 'test') AND (t.s = e.s OR t.o = e.o OR bit_count(xor(t.h, e.h)) <= 4) GROUP BY 1)
 SELECT image_id, sp AS split, n AS train_records, CASE WHEN p.o THEN 'o' ELSE '' END || CASE WHEN p.p THEN 'p' ELSE '' END || CASE WHEN p.s THEN 's' ELSE '' END AS kinds,
  CAST(CASE WHEN p.s THEN length(j.s) ELSE 0 END + bit_count(d) + CASE WHEN p.o THEN length(j.o) ELSE 0 END AS DOUBLE) / (coalesce(length(j.s), 0) + CASE WHEN j.h IS NULL THEN 0 ELSE 16 END + coalesce(length(j.o), 0)) AS coverage
 FROM j JOIN p ON p.i = j.image_id"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": _P2, "p2_report": _P2_REPORT, "p3_found": _P3, "p4_found": _P4, "p4_report": _P4_REPORT, "p4_coverage": _P4_COVERAGE}
