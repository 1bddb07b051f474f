"""Deterministic ranks, caps, quotas and samples."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siftwork.session import cut, shuffle_partitions


#: Salted parts of a group in a long top list.
SALTS = 32
#: Rows of one stretch of the sequential selection.
CHUNK_ROWS = 200_000


def global_rank(df: DataFrame, order: Sequence[str], name: str = "rank") -> DataFrame:
    """``df`` with its rank from 1 in a total order. The rows are range-partitioned once and written; ranks are local
    ranks plus the counts of the partitions before, so no task sees all rows."""
    parts = cut(df.repartitionByRange(shuffle_partitions(df.sparkSession), *order).withColumn("_p", F.spark_partition_id()), "ranged")
    counts = sorted((r["_p"], r["n"]) for r in parts.groupBy("_p").agg(F.count("*").alias("n")).collect())  # a row per partition
    base, seen = [], 0
    for p, n in counts:
        base.append((p, seen))
        seen += n
    offset = F.broadcast(df.sparkSession.createDataFrame(base, "_p int, _base bigint"))
    local = F.row_number().over(Window.partitionBy("_p").orderBy(*order))
    return parts.join(offset, "_p").withColumn(name, local + F.col("_base")).drop("_p", "_base")


#: Rows that a plain limit may gather in one task.
GATHER = 100_000


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a total order. More than GATHER of them are cut by global rank, so no task gathers them."""
    if n <= GATHER:
        return df.orderBy(*order).limit(n)
    return global_rank(df, order, "_rank").where(F.col("_rank") <= n).drop("_rank")


def top_per_group(df: DataFrame, group: str, order: Sequence[str | Column], n: int | Column) -> DataFrame:
    """The first ``n`` rows of each group by ``order``. Up to a constant n of 1,000, Spark limits the groups before the
    shuffle; above it, the rows of a group are first cut in 32 salted parts, so a hot group isn't sorted by one task."""
    if isinstance(n, int) and n > 1000:
        salt = F.pmod(F.xxhash64(*order), F.lit(SALTS))
        part = F.row_number().over(Window.partitionBy(group, "_salt").orderBy(*order))
        df = df.withColumn("_salt", salt).withColumn("_r", part).where(F.col("_r") <= n).drop("_r", "_salt")
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("_r", rank).where(F.col("_r") <= n).drop("_r")


def largest_remainder(weights: Mapping[str, float], total: int) -> dict[str, int]:
    """Whole numbers in proportion to ``weights`` that sum to ``total``: floors, then one each to the largest remainders,
    ties by key."""
    if total < 0 or not weights or min(weights.values()) < 0 or sum(weights.values()) <= 0:
        raise ValueError("total must not be negative, weights must be some, not negative, and not all zero")
    whole = sum(weights.values())
    exact = {k: total * v / whole for k, v in weights.items()}
    out = {k: int(math.floor(x)) for k, x in exact.items()}
    for k in sorted(exact, key=lambda k: (out[k] - exact[k], k))[: total - sum(out.values())]:
        out[k] += 1
    return out


def allocate(groups: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """(key, quota): :func:`largest_remainder` over a table of groups, however many. The window that sums all weights
    sees one row per group."""
    if total < 0:
        raise ValueError("total must not be negative")
    every = groups.agg(F.sum(weight).alias("_w"))
    whole = every.first()["_w"]
    exact = F.lit(total) * F.col(weight) / F.lit(whole)
    base = groups.select(key, F.floor(exact).alias("_f"), (exact - F.floor(exact)).alias("_rest"))
    short = total - (base.agg(F.sum("_f")).first()[0] or 0)
    extra = first_rows(base.withColumn("_less", -F.col("_rest")), ["_less", key], int(short)).select(key, F.lit(1).alias("_x"))
    return base.join(extra, key, "left").select(key, (F.col("_f") + F.coalesce("_x", F.lit(0))).cast("bigint").alias("quota"))


def requested_units(requested: Sequence[str], available: DataFrame, unit: str) -> DataFrame:
    """(pos, unit): the distinct requested units in the order asked for; one that isn't available is an error."""
    order = list(dict.fromkeys(requested))
    want = available.sparkSession.createDataFrame([(i, u) for i, u in enumerate(order)], f"pos int, {unit} string")
    unknown = want.join(available.select(unit).distinct(), unit, "left_anti").select(unit).limit(20).collect()
    if unknown:
        raise ValueError("unknown units: " + ", ".join(sorted(r[0] for r in unknown)))
    return want


def unit_caps(units: DataFrame, unit: str, every: int, caps: Mapping[str, int]) -> DataFrame:
    """``units`` with ``cap``: the unit's own cap, the one for all where that is less or there is none."""
    if every <= 0 or any(n <= 0 for n in caps.values()):
        raise ValueError("caps must be positive")
    own = units.sparkSession.createDataFrame(list(caps.items()), f"{unit} string, _cap int")
    return units.join(own, unit, "left").withColumn("cap", F.least(F.lit(every), F.coalesce("_cap", F.lit(every)))).drop("_cap")


def scan_report(df: DataFrame, unit: str, order: Sequence[str], target: int) -> DataFrame:
    """(unit, offered, within_cap, emitted, truncated) of a round-robin scan over ``df``, which has a ``cap`` on each row:
    how many rows of a unit there are, lie within its cap, are emitted before ``target`` is reached, and whether
    rows were left."""
    rank = F.row_number().over(Window.partitionBy(unit).orderBy(*order))
    within = df.withColumn("_r", rank).where(F.col("_r") <= F.col("cap"))
    count = lambda part, name: part.groupBy(unit).agg(F.count("*").alias(name))
    out = count(df, "offered").join(count(within, "within_cap"), unit, "left").join(count(first_rows(within, order, target), "emitted"), unit, "left")
    n = lambda c: F.coalesce(c, F.lit(0))
    return out.select(unit, "offered", n("within_cap").alias("within_cap"), n("emitted").alias("emitted"), (F.col("offered") > n("emitted")).alias("truncated"))


def pilot(df: DataFrame, category: str, counts: Mapping[str, int], order: Sequence[str], name: str = "pilot_id") -> DataFrame:
    """The first rows of each category, as many as ``counts`` says, with ids from 1 in ``order``. Too few rows of a
    category are an error."""
    have = {r[0]: r["n"] for r in df.where(F.col(category).isin(*counts)).groupBy(category).agg(F.count("*").alias("n")).collect()}  # a row per asked category
    short = {c: n - have.get(c, 0) for c, n in counts.items() if have.get(c, 0) < n}
    if short:
        raise ValueError(f"too few rows: {short}")
    want = F.broadcast(df.sparkSession.createDataFrame(list(counts.items()), f"{category} string, _most int"))  # the asked categories
    some = top_per_group(df.where(F.col(category).isin(*counts)), category, order, max(counts.values()))
    rank = F.row_number().over(Window.partitionBy(category).orderBy(*order))
    chosen = some.withColumn("_r", rank).join(want, category).where(F.col("_r") <= F.col("_most")).drop("_r", "_most")
    return global_rank(chosen, order, name)


def round_robin_cap(df: DataFrame, unit: str, order: Sequence[str], cap: int | Column, target: int) -> DataFrame:
    """What a round-robin scan of one shard per unit and round would emit: each unit's first ``cap`` rows in scan order,
    then the first ``target`` of all. ``order``'s columns are the scan order; ``cap`` is a number or a column that is the
    same for all rows of a unit, as from :func:`unit_caps`."""
    if target <= 0 or (isinstance(cap, int) and cap <= 0):
        raise ValueError("cap and target must be positive")
    return first_rows(top_per_group(df, unit, order, cap), order, target)


def shard_order(df: DataFrame, seed: str, unit: str, shard: str, offset: int = 0, most: int | None = None) -> DataFrame:
    """(unit, shard, shard_pos): a deterministic permutation of each unit's shards and a slice of it."""
    rank = F.row_number().over(Window.partitionBy(unit).orderBy(F.sha2(F.concat(F.lit(f"{seed}:"), F.upper(unit), F.lit(":"), F.element_at(F.split(shard, "/"), -1)), 256), shard)) - 1
    ranked = df.select(unit, shard).distinct().withColumn("shard_pos", rank)
    return ranked.where(F.col("shard_pos") >= offset if most is None else F.col("shard_pos").between(offset, offset + most - 1))


def _accept(pool: DataFrame, order: Sequence[str], object_col: str, object_cap: int, taken_obj: DataFrame, inst_col: str | None, inst_cap: int, taken_inst: DataFrame | None, quota: int) -> DataFrame:
    """The stacked windows of one category. The plain caps come first, as constants: Spark then keeps so many rows of a
    group in each map task already, so a hot object or institution is cut before the shuffle."""
    ok = top_per_group(pool, object_col, order, object_cap)
    rank = F.row_number().over(Window.partitionBy(object_col).orderBy(*order))
    ok = ok.join(taken_obj, object_col, "left").withColumn("_o", rank).where(F.col("_o") + F.coalesce("_no", F.lit(0)) <= object_cap).drop("_o", "_no")
    if inst_col:
        ok = top_per_group(ok, inst_col, order, inst_cap)
        rank = F.row_number().over(Window.partitionBy(inst_col).orderBy(*order))
        ok = ok.join(taken_inst, inst_col, "left").withColumn("_i", rank).where(F.col("_i") + F.coalesce("_ni", F.lit(0)) <= inst_cap).drop("_i", "_ni")
    return first_rows(ok, order, quota)


def greedy_quotas(df: DataFrame, category: str, quotas: Mapping[str, int], order: Sequence[str], object_col: str, object_cap: int, inst_col: str | None = None, inst_cap: int = 0, fill: bool = False) -> DataFrame:
    """Greedy selection, category by category in the order of ``quotas``: rows in ``order``, at most ``object_cap`` of an
    object and ``inst_cap`` of an institution over all categories, up to the category's quota.

    Inside a category the three caps are stacked windows, which equals the row-by-row loop if each object has one
    institution; :func:`one_institution` tells. Where it has several, the category's rows run through the loop in
    stretches of 200,000, which bounds the rows of a task. Accepted rows are written between the categories, and the
    counts carried are aggregates of them. Categories without a quota are left out; a category that ``df`` lacks gives no rows.
    With ``fill``, a quota that can't be filled is an error.
    """
    df = cut(df.where(F.col(category).isin(*quotas)), "pool")  # read once for each category
    exact = inst_col is None or one_institution(df, object_col, inst_col)
    spark = df.sparkSession
    done: list[DataFrame] = []
    no = spark.createDataFrame([], f"{object_col} {df.schema[object_col].dataType.simpleString()}, _no bigint")
    ni = spark.createDataFrame([], f"{inst_col} {df.schema[inst_col].dataType.simpleString()}, _ni bigint") if inst_col else None
    for name, quota in quotas.items():
        pool = df.where(F.col(category) == name)
        if exact:
            part = _accept(pool, order, object_col, object_cap, no, inst_col, inst_cap, ni, quota)
        else:
            part = _sequential(pool, order, object_col, object_cap, no, inst_col, inst_cap, ni, quota)
        done.append(cut(part, "accepted") if exact else part)  # the loop has written its rows
        if fill and (got := done[-1].count()) < quota:
            raise ValueError(f"{name} has {got} of {quota} rows")
        every = done[0].select(object_col, *([inst_col] if inst_col else []))
        for d in done[1:]:
            every = every.unionByName(d.select(*every.columns))
        no = every.groupBy(object_col).agg(F.count("*").alias("_no"))
        ni = every.groupBy(inst_col).agg(F.count("*").alias("_ni")) if inst_col else None
    out = done[0] if done else df.limit(0)
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def one_institution(df: DataFrame, object_col: str, inst_col: str) -> bool:
    """Whether no object has two institutions."""
    return df.groupBy(object_col).agg((F.min(inst_col) != F.max(inst_col)).alias("x")).where("x").isEmpty()


def _sequential(pool: DataFrame, order: Sequence[str], object_col: str, object_cap: int, no: DataFrame, inst_col: str, inst_cap: int, ni: DataFrame, quota: int) -> DataFrame:
    """The loop itself, over stretches of CHUNK_ROWS rows in order; rows of objects and institutions that are full already
    are left out of a stretch. A pool of no more rows is one stretch as it is."""
    names, got, parts, last = pool.columns, 0, [], None
    whole = pool.limit(CHUNK_ROWS + 1).count() <= CHUNK_ROWS
    while got < quota:
        full_obj, full_inst = no.where(F.col("_no") >= object_cap), ni.where(F.col("_ni") >= inst_cap)
        left = pool if last is None else pool.where(F.struct(*order) > F.struct(*[F.lit(x).cast(pool.schema[c].dataType).alias(c) for c, x in zip(order, last)]))
        stretch = left.join(full_obj.select(object_col), object_col, "left_anti").join(full_inst.select(inst_col), inst_col, "left_anti")
        if not whole:
            stretch = cut(stretch.orderBy(*order).limit(CHUNK_ROWS), "stretch")
            end = stretch.agg(F.max(F.struct(*order)).alias("x")).first()["x"]
            if end is None:
                break
            last = tuple(end)
        rows = stretch.join(no, object_col, "left").join(ni, inst_col, "left").withColumn("_no", F.coalesce("_no", F.lit(0))).withColumn("_ni", F.coalesce("_ni", F.lit(0)))

        def run(pdf: pd.DataFrame, room: int = quota - got) -> pd.DataFrame:
            pdf = pdf.sort_values(list(order), kind="stable")
            objs, insts = dict(zip(pdf[object_col], pdf["_no"])), dict(zip(pdf[inst_col], pdf["_ni"]))
            keep: list[int] = []
            for i, (o, u) in enumerate(zip(pdf[object_col], pdf[inst_col])):
                if len(keep) >= room:
                    break
                if objs[o] < object_cap and insts[u] < inst_cap:
                    keep.append(i)
                    objs[o] += 1
                    insts[u] += 1
            return pdf.iloc[keep][names]

        part = cut(rows.withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(lambda p: run(p), pool.schema), "accepted")
        parts.append(part)
        if whole:
            break
        got += part.count()
        no = no.unionByName(part.groupBy(object_col).agg(F.count("*").alias("_no"))).groupBy(object_col).agg(F.sum("_no").alias("_no"))
        ni = ni.unionByName(part.groupBy(inst_col).agg(F.count("*").alias("_ni"))).groupBy(inst_col).agg(F.sum("_ni").alias("_ni"))
    out = pool.limit(0)
    for part in parts:
        out = out.unionByName(part)
    return out


def shortfalls(supply: DataFrame, category: str, quotas: Mapping[str, int]) -> DataFrame:
    """(category, quota, selected, shortfall) where fewer rows than the quota were selected."""
    want = supply.sparkSession.createDataFrame(list(quotas.items()), f"{category} string, quota bigint")
    got = supply.groupBy(category).agg(F.count("*").alias("selected"))
    out = want.join(got, category, "left").withColumn("selected", F.coalesce("selected", F.lit(0)))
    return out.where("selected < quota").withColumn("shortfall", F.col("quota") - F.col("selected"))


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """(value, n): the most frequent values, ties by value."""
    return df.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value").limit(n)


def best_exclusive(df: DataFrame, group: str, score: str, object_col: str, id_col: str, groups: Sequence[str]) -> DataFrame:
    """For each of ``groups`` in turn the row with the best score, an object used once at most. Each step is a top-1 with
    the chosen objects left out; what stays on the driver is a row per group."""
    used: list = []
    out: list = []
    for g in groups:
        pool = df.where(F.col(group) == g)
        if used:
            pool = pool.where(~F.col(object_col).isin(used))
        row = pool.select(group, id_col, object_col, score).orderBy(F.desc(score), id_col).first()
        if row:
            used.append(row[object_col])
            out.append(tuple(row))
    return df.sparkSession.createDataFrame(out, df.select(group, id_col, object_col, score).schema)


def hash_sample(df: DataFrame, seed: str, id_col: str, n: int) -> DataFrame:
    """``n`` rows in the order of a seeded hash: the same rows whatever the partitioning."""
    return first_rows(df.withColumn("_hash", F.sha2(F.concat(F.lit(seed), F.col(id_col).cast("string")), 256)), ["_hash", id_col], n).drop("_hash")
