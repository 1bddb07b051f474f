"""Profiles and summary reports, each in one pass where the counts allow it."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwork.functions.text import missing_blank, missing_falsy
from siftwork.functions.values import ratio
from siftwork.session import cut, shuffle_partitions


def frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, value, n) for several columns at once; null counts as the empty text."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c).cast("string"), F.lit("")).alias("value")) for c in columns])).alias("p")
    return df.select(pairs).groupBy("p.column", "p.value").agg(F.count("*").alias("n"))


def token_frequencies(df: DataFrame, column: str, sep: str = ";", n: int = 100) -> DataFrame:
    """(token, n): the most frequent trimmed non-empty tokens, ties by token."""
    token = F.explode(F.filter(F.transform(F.split(column, sep), lambda x: F.trim(x)), lambda x: x != "")).alias("token")
    return df.select(token).groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(n)


def missing(df: DataFrame, columns: Sequence[str], blank: bool = False) -> DataFrame:
    """(column, missing, total, ratio), all columns in one aggregate. ``blank`` counts blank text as missing too; the ratio
    is rounded half to even to 4 places, 0.0 for an empty table."""
    test = missing_blank if blank else missing_falsy
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(test(c)).alias(c) for c in columns])
    long = one.select("_n", F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing")) for c in columns])).alias("x"))
    return long.select("x.column", "x.missing", F.col("_n").alias("total"), ratio("x.missing", "_n", 4).alias("ratio"))


def percentiles(df: DataFrame, column: str, parts: Sequence[float]) -> list[float | None]:
    """Linearly interpolated percentiles of the non-null values; null if there are none. Values are counted, their counts
    range-partitioned, and only the partitions in which a wanted rank falls are ordered; the driver sees a count per
    partition and two values per percentile."""
    spark = df.sparkSession
    v = F.col(column).cast("double").alias("v")
    counted = df.select(v).where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("n"))
    ranged = cut(counted.repartitionByRange(shuffle_partitions(spark), "v").withColumn("_p", F.spark_partition_id()), "values")
    sums = sorted((r["_p"], r["n"]) for r in ranged.groupBy("_p").agg(F.sum("n").alias("n")).collect())
    total = sum(n for _, n in sums)
    if not total:
        return [None] * len(parts)
    places = [x * (total - 1) for x in parts]
    ranks = sorted({r for x in places for r in (math.floor(x), math.ceil(x))})
    base, seen = {}, 0
    for p, n in sums:
        if any(seen <= r < seen + n for r in ranks):
            base[p] = seen
        seen += n
    start = F.element_at(F.create_map(*[F.lit(x) for kv in base.items() for x in kv]), F.col("_p"))
    upto = F.sum("n").over(Window.partitionBy("_p").orderBy("v")) + start
    hit = F.filter(F.array(*[F.lit(r) for r in ranks]), lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")))
    found = ranged.where(F.col("_p").isin(*base)).withColumn("upto", upto).select("v", F.explode(hit).alias("r")).collect()  # at most a row per rank
    at = {r["r"]: r["v"] for r in found}
    return [at[math.floor(x)] + (at[math.ceil(x)] - at[math.floor(x)]) * (x - math.floor(x)) for x in places]


def summary(df: DataFrame, column: str) -> DataFrame:
    """(n, mean, p50, p95, least, most) of the non-null values, percentiles linearly interpolated; null if there are none."""
    c = F.col(column).cast("double")
    p50, p95 = percentiles(df, column, (0.5, 0.95))
    return df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.lit(p50).cast("double").alias("p50"), F.lit(p95).cast("double").alias("p95"), F.min(c).alias("least"), F.max(c).alias("most"))


def group_sizes(df: DataFrame, object_col: str) -> DataFrame:
    """(objects, rows, multi_row_objects, most_rows)."""
    per = df.groupBy(object_col).agg(F.count("*").alias("n"))
    return per.agg(F.count(object_col).alias("objects"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.count_if(F.col("n") > 1).alias("multi_row_objects"), F.coalesce(F.max("n"), F.lit(0)).alias("most_rows"))


def supply(df: DataFrame, category: str, object_col: str) -> DataFrame:
    """(category, rows, objects)."""
    per = df.groupBy(category, object_col).agg(F.count("*").alias("n"))
    return per.groupBy(category).agg(F.sum("n").alias("rows"), F.count(object_col).alias("objects"))


def usable_ratio(df: DataFrame, status: str, usable: Sequence[str]) -> DataFrame:
    """(total, usable, ratio)."""
    one = df.agg(F.count("*").alias("total"), F.count_if(F.col(status).isin(*usable)).alias("usable"))
    return one.select("total", "usable", ratio("usable", "total", 4).alias("ratio"))


def package_projection(df: DataFrame, bytes_col: str, target_rows: int, extra_bytes: int, go_gb: float, cap_gb: float, ok: str | None = None, seconds_col: str | None = None, parallel: int = 1) -> DataFrame:
    """(mean_bytes, projected_gb, verdict): GO within the target size, ADJUST within the cap, else STOP; no rows to measure
    are projected as infinite. With ``seconds_col``, also the hours that the target rows take so many at a time."""
    c = F.col(bytes_col).cast("double")
    hours = [(F.avg(F.col(seconds_col).cast("double")) * target_rows / 3600 / parallel).alias("projected_hours")] if seconds_col else []
    one = (df.where(ok) if ok else df).agg(F.avg(c).alias("mean_bytes"), *hours)
    gb = F.coalesce((F.col("mean_bytes") * target_rows + extra_bytes) / F.lit(1e9), F.lit(float("inf")))
    return one.select("mean_bytes", gb.alias("projected_gb"), F.when(gb <= go_gb, "GO").when(gb <= cap_gb, "ADJUST").otherwise("STOP").alias("verdict"), *(["projected_hours"] if seconds_col else []))


def package_bytes(df: DataFrame, bytes_col: str) -> DataFrame:
    """(rows, total_bytes, package_gb): a null size counts as 0."""
    one = df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.coalesce(bytes_col, F.lit(0))), F.lit(0)).alias("total_bytes"))
    return one.select("rows", "total_bytes", F.round(F.col("total_bytes") / F.lit(1e9), 6).alias("package_gb"))


def outcomes(df: DataFrame, columns: Sequence[str], category: str, status: str, success: str) -> DataFrame:
    """(kind, value, n): counts of each code in ``columns``, nulls left out, and of successes and failures by category, in
    one pass."""
    ok = F.when(F.coalesce(F.col(status) == success, F.lit(False)), "success").otherwise("failure")
    parts = [F.struct(F.lit(c).alias("kind"), F.col(c).cast("string").alias("value")) for c in columns]
    parts.append(F.struct(F.concat(F.lit(f"{category}:"), ok).alias("kind"), F.coalesce(F.col(category).cast("string"), F.lit("")).alias("value")))
    return df.select(F.explode(F.array(*parts)).alias("x")).select("x.*").where("value IS NOT NULL").groupBy("kind", "value").agg(F.count("*").alias("n"))


def label_frequencies(df: DataFrame, group: str, label: str, n: int = 30) -> DataFrame:
    """(group, label, n): the most frequent labels of each group, ties by label; a missing one is shown as ``<missing>``."""
    named = F.when(missing_blank(label), "<missing>").otherwise(F.trim(label)).alias("label")
    return top_per_key(df.select(F.col(group).alias("group"), named).groupBy("group", "label").agg(F.count("*").alias("n")), "group", "label", "n", n)


def anomalies(df: DataFrame, part: str, whole: str) -> DataFrame:
    """Rows whose part exceeds the whole."""
    return df.where(F.col(part) > F.col(whole))


def json_keys(df: DataFrame, column: str) -> DataFrame:
    """(key, kind, n): the keys of JSON objects and the kinds of their values; broken JSON is skipped."""
    v = F.try_parse_json(column)
    pairs = df.select(F.explode(F.from_json(F.when(v.isNotNull(), F.col(column)), "map<string,string>")).alias("key", "value"), v.alias("v"))
    first = F.left(F.ltrim("value"), F.lit(1))
    kind = F.when(F.col("value").isNull(), "null").when(first == "{", "object").when(first == "[", "array").when(F.expr("try_cast(value AS DOUBLE)").isNotNull(), "number").when(F.col("value").isin("true", "false"), "boolean").otherwise("string")
    return pairs.groupBy("key", kind.alias("kind")).agg(F.count("*").alias("n"))


def top_per_key(counts: DataFrame, key: str, value: str, n_col: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of each key, ties by value."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(n_col), value))
    return counts.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def first_samples(df: DataFrame, predicate: str, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows that satisfy the predicate, in input order."""
    return df.where(predicate).orderBy(*order).limit(n)
