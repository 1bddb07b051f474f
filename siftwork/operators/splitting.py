"""Splits by object and their leakage checks."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.session import cut

SPLITS = ("train", "validation", "test")
#: Objects of a category that one task deals out. A larger category is dealt chunk by chunk in its hash order, and what each
#: split holds is carried on, so the result doesn't depend on it.
CHUNK = 1_000_000


def primary_category(df: DataFrame, object_col: str, category: str, default: str = "") -> DataFrame:
    """(object, category, size): an object's most frequent category, ties to the least; size counts its rows. Two levels
    of partial aggregates; no window."""
    per = df.groupBy(object_col, F.coalesce(F.col(category).cast("string"), F.lit(default)).alias(category)).agg(F.count("*").alias("n"))
    least = F.min(F.struct((-F.col("n")).alias("m"), F.col(category).alias("c")))
    return per.groupBy(object_col).agg(least.alias("_x"), F.sum("n").alias("size")).select(object_col, F.col("_x.c").alias(category), "size")


def assign_object_splits(df: DataFrame, object_col: str, category: str, seed: str, ratios: Sequence[float] = (0.8, 0.1, 0.1), names: Sequence[str] = SPLITS, default: str = "") -> DataFrame:
    """(object, category, size, split): in each category, objects in hash order, each to the split that lacks most rows,
    ties to the earlier split. Null objects are an error; null categories count as ``default``."""
    if len(ratios) != len(names) or abs(sum(ratios) - 1) > 1e-9 or min(ratios) <= 0:
        raise ValueError("ratios must be as many as names, positive, and sum to 1")
    if not df.where(F.coalesce(F.col(object_col).cast("string"), F.lit("")) == "").isEmpty():
        raise ValueError("every row must have an object")
    prime = primary_category(df, object_col, category, default).withColumn("_rank", F.sha2(F.concat_ws(":", F.lit(seed), category, F.col(object_col).cast("string")), 256))
    counts = prime.groupBy(category).agg(F.ceil(F.count("*") / F.lit(CHUNK)).alias("_chunks"), F.sum("size").alias("_total"))
    few = counts.limit(100_001).count() <= 100_000
    prime = prime.join(F.broadcast(counts) if few else counts, category)
    prime = prime.withColumn("_slot", F.floor(F.conv(F.left("_rank", F.lit(8)), 16, 10).cast("bigint") * F.col("_chunks") / F.lit(2**32)))
    kind = df.schema[object_col].dataType.simpleString()
    held = [f"_h{i}" for i in range(len(names))]

    def deal(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_rank")
        total = int(pdf["_total"].iloc[0])
        target = [r * total for r in ratios]
        given = [int(pdf[h].iloc[0]) for h in held]
        out = []
        for n in pdf["size"]:
            lack = [t - g for t, g in zip(target, given)]
            k = int(np.argmax(lack))
            given[k] += int(n)
            out.append(names[k])
        return pdf[[object_col, category, "size"]].assign(split=out)

    def step(part: DataFrame) -> DataFrame:
        return part.select(object_col, category, "size", "_rank", "_total", *held).groupBy(category).applyInPandas(deal, f"{object_col} {kind}, {category} string, size bigint, split string")

    most = prime.agg(F.max("_chunks")).first()[0] or 1
    if most == 1:
        return step(prime.withColumns(dict.fromkeys(held, F.lit(0))))
    prime = cut(prime, "objects")
    out: DataFrame | None = None
    for k in range(most):
        part = prime.where(F.col("_slot") == k)
        if out is None:
            part = part.withColumns(dict.fromkeys(held, F.lit(0)))
        else:
            loads = out.groupBy(category).agg(*[F.coalesce(F.sum(F.when(F.col("split") == n, F.col("size"))), F.lit(0)).alias(h) for n, h in zip(names, held)])
            part = part.join(F.broadcast(loads) if few else loads, category, "left").na.fill(0, held)
        done = cut(step(part), "dealt")
        out = done if out is None else out.unionByName(done)
    return out


def split_counts(rows: DataFrame, object_col: str = "object_id", split: str = "split") -> DataFrame:
    """(split, rows, objects)."""
    per = rows.groupBy(split, object_col).agg(F.count("*").alias("n"))
    return per.groupBy(split).agg(F.sum("n").alias("rows"), F.count(object_col).alias("objects"))


def split_crosstab(rows: DataFrame, category: str, split: str = "split", names: Sequence[str] = SPLITS) -> DataFrame:
    """(category, one column per split): row counts."""
    return rows.groupBy(category).agg(*[F.count_if(F.col(split) == n).alias(n) for n in names])


def leakage(rows: DataFrame, object_col: str = "object_id", split: str = "split", names: Sequence[str] = SPLITS) -> DataFrame:
    """(a, b, objects): how many objects stand in both splits of each pair, in one pass; and for how many splits an object
    has at most, as the pair (any, any)."""
    per = rows.groupBy(object_col).agg(*[F.max(F.col(split) == n).alias(n) for n in names])
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    agg = per.agg(*[F.count_if(F.col(a) & F.col(b)).alias(f"{a}|{b}") for a, b in pairs], F.coalesce(F.max(sum((F.col(n).cast("int") for n in names), F.lit(0))), F.lit(0)).cast("bigint").alias("any|any"))
    cols = [f"{a}|{b}" for a, b in pairs] + ["any|any"]
    return agg.select(F.explode(F.array(*[F.struct(F.lit(c.split("|")[0]).alias("a"), F.lit(c.split("|")[1]).alias("b"), F.col(c).alias("objects")) for c in cols])).alias("x")).select("x.*")
