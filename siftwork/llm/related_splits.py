"""Splits that keep related records together."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwork.functions.keys import norm_key, one_row_per
from siftwork.operators.graph import connected_components
from siftwork.session import cut, join_hot

SPLITS = ("train", "validation", "test")
RATIOS = (0.8, 0.1, 0.1)

#: Components of one annealing shard, about. A component above one part in HEAVY of all records is placed first; there
#: can be at most HEAVY of them, whatever the data, so they are the only ones that meet in one task.
SHARD, HEAVY = 20_000, 2_000
#: Parallel chains in each shard and proposals in each chain for each component.
CHAINS, STEPS = 4, 6


def related_groups(records: DataFrame, id_col: str = "image_id", object_col: str = "object_id", media_col: str = "media_id", extra: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """(records, groups). records: (id, obj, ...extra), one row per distinct id, ``obj`` the normalised object or an own
    key where it is null. groups: (obj, group_id, n_objects) of the objects that a shared medium ties to another object;
    ``group_id`` is the smallest id of the group.

    Keys are compared without letter case and surrounding blanks. A media id that is null or has no digit joins
    nothing. Rows whose id is null are left out, copies of an id count once (the least one).
    """
    once = one_row_per(records.select(id_col, norm_key(object_col).alias("obj"), F.when(norm_key(media_col).rlike("[0-9]"), norm_key(media_col)).alias("med"), *extra), id_col, ["obj", "med", *extra])
    base = cut(once.withColumn("obj", F.coalesce("obj", F.concat(F.lit("\u0001"), F.col(id_col).cast("string")))), "records")
    return base, _groups(base, id_col)


def _groups(base: DataFrame, id_col: str) -> DataFrame:
    pairs = base.where("med IS NOT NULL").groupBy("med", "obj").agg(F.lit(1).alias("one")).select("med", "obj")
    least = pairs.groupBy("med").agg(F.min("obj").alias("first"), F.max("obj").alias("last")).where("first <> last").select("med", "first")
    ties = cut(pairs.join(least, "med").where("obj <> first").select("obj", "first").distinct(), "ties")
    linked = ties.select("obj").unionAll(ties.select(F.col("first").alias("obj"))).distinct()
    node = cut(base.groupBy("obj").agg(F.min(id_col).alias("node")).join(linked, "obj"), "nodes")  # a hot object is one row before the join
    edges = ties.join(node, "obj").select("first", F.col("node").alias("a")).join(node.select(F.col("obj").alias("first"), F.col("node").alias("b")), "first").select("a", "b")
    comp = connected_components(edges)
    size = comp.groupBy("component").agg(F.count("*").alias("n_objects"))
    return node.join(comp, "node").join(size, "component").select("obj", F.col("component").alias("group_id"), "n_objects")


def anneal(vectors: np.ndarray, start: np.ndarray, want: np.ndarray, seed: int, chains: int = CHAINS, steps: int = STEPS, scale: np.ndarray | None = None) -> np.ndarray:
    """Component swap search. ``vectors``: a row per component with its size and then its records of each label;
    ``start``: its split; ``want``: a row per split of the same columns; a deviation counts as a part of ``scale``, by
    default the sum of what is wanted. Each chain proposes to move a component or to
    exchange two of different splits, takes what lowers the deviation and, by a falling temperature, some of what
    raises it. The best assignment of all chains, the start included, is returned."""
    n, k = len(vectors), len(want)
    best, best_cost = start.copy(), np.inf
    if n == 0:
        return best
    scale = np.maximum(want.sum(axis=0) if scale is None else scale, 1e-9)
    weight = np.full(vectors.shape[1], 1 / max(1, vectors.shape[1] - 1))
    weight[0] = 1
    factor = np.sqrt(weight) / scale
    v, w = vectors * factor, want * factor
    for chain in range(chains):
        rng = np.random.default_rng([seed, chain])
        now = start.copy()
        load = np.zeros_like(w)
        np.add.at(load, now, v)
        off = load - w
        cost = float((off**2).sum())
        if cost < best_cost:
            best, best_cost = now.copy(), cost
        total = max(200, steps * n)
        heat = 0.3 * cost / max(1, n)
        pick, other, to, luck = rng.integers(0, n, total), rng.integers(0, n, total), rng.integers(0, k, total), rng.random(total)
        swap = rng.random(total) < 0.5
        for t in range(total):
            i = pick[t]
            a = now[i]
            if swap[t]:
                j = other[t]
                b = now[j]
                delta = v[j] - v[i]
            else:
                j, b, delta = -1, to[t], -v[i]
            if a == b:
                continue
            oa, ob = off[a], off[b]
            change = float(2 * (delta @ (oa - ob)) + 2 * (delta @ delta))
            if change < 0 or luck[t] < np.exp(-change / max(1e-300, heat * (1 - t / total))):
                if change > 0 and cost < best_cost - 1e-15:
                    best, best_cost = now.copy(), cost
                off[a] = oa + delta
                off[b] = ob - delta
                now[i] = b
                if j >= 0:
                    now[j] = a
                cost += change
        if cost < best_cost - 1e-15:
            best, best_cost = now.copy(), cost
    return best


def assign_splits(records: DataFrame, id_col: str = "image_id", object_col: str = "object_id", media_col: str = "media_id", label_col: str = "category_code", ratios: tuple[float, ...] = RATIOS, names: tuple[str, ...] = SPLITS, seed: int = 7) -> DataFrame:
    """(id, group_id, n_objects, label, split): records tied by object or medium share a split; sizes and labels are near
    ``ratios``. ``n_objects`` is the number of objects of the group, ``label`` the normalised label.

    Each component starts in the split its hash gives. The heavy components, at most 2,000 whatever the data, are
    annealed together against the targets of all records, in size and in each label; the rest is dealt by hash to shards
    of about 20,000 components, which anneal in parallel. For the size and for each label, a shard aims at its part of
    what the heavy ones left of every split's target, below zero where they hold more than that. Null labels are a
    label of their own. The result depends on the data and ``seed`` only.
    """
    if len(ratios) != len(names) or abs(sum(ratios) - 1) > 1e-9 or min(ratios) < 0:
        raise ValueError("ratios must be as many as names, not negative, and sum to 1")
    base, groups = related_groups(records.withColumn("_label", F.coalesce(norm_key(label_col), F.lit(""))), id_col, object_col, media_col, ("_label",))
    own = cut(base.groupBy("obj").agg(F.min(id_col).alias("own_id"), F.count("*").alias("n")), "objects")
    key = own.select("obj", "own_id").join(groups, "obj", "left").select("obj", F.coalesce("group_id", "own_id").alias("group_id"), F.coalesce("n_objects", F.lit(1)).alias("n_objects"))
    keyed = join_hot(base.select(id_col, "obj", "_label"), key, "obj", id_col, own.select("obj", "n")).select(id_col, "_label", "group_id", "n_objects")
    keyed = cut(keyed, "keyed")
    cells = keyed.groupBy("group_id", "_label").agg(F.count("*").alias("n"))
    comps = cut(cells.groupBy("group_id").agg(F.sum("n").alias("size"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("_label", "n")))).alias("labels")), "components")
    total, count = comps.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    heavy = F.col("size") * HEAVY > max(total, 1)
    shards = max(1, -(-count // SHARD))
    hashed = F.pmod(F.xxhash64(F.lit(seed), "group_id"), F.lit(1_000_000)) / F.lit(1_000_000.0)
    bounds = np.cumsum(ratios)
    start = F.lit(len(names) - 1)
    for i in range(len(names) - 2, -1, -1):
        start = F.when(hashed < float(bounds[i]), i).otherwise(start)
    comps = comps.withColumn("start", start.cast("int")).withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "group_id"), F.lit(shards)).cast("int"))
    shape = "group_id bigint, split int"

    def vectors(pdf: pd.DataFrame, labels: list[str]) -> np.ndarray:
        at = {k: i + 1 for i, k in enumerate(labels)}
        v = np.zeros((len(pdf), len(labels) + 1))
        v[:, 0] = pdf["size"]
        for i, d in enumerate(pdf.labels):
            for k, n in dict(d).items():
                v[i, at[k]] = n
        return v

    share = np.array(ratios)
    sums = comps.select(heavy.alias("heavy"), F.explode("labels").alias("_label", "n")).groupBy("_label").agg(F.sum("n").alias("total"), F.sum(F.when(~F.col("heavy"), F.col("n"))).alias("rest"))

    def place_heavy(key: tuple, pdf: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        pdf, marks = pdf.sort_values("group_id"), marks.sort_values("_label")
        v = vectors(pdf, list(marks["_label"]))
        totals = np.array([total, *marks.total], dtype=float)
        return pd.DataFrame({"group_id": pdf.group_id, "split": anneal(v, pdf.start.to_numpy(), np.outer(share, totals), seed, steps=60)})

    one = comps.where(heavy).withColumn("shard", F.lit(0))
    own_marks = one.select(F.col("shard").alias("of"), F.explode(F.map_keys("labels")).alias("_label")).distinct().join(sums, "_label").select("of", "_label", "total")
    big = one.groupBy("shard").cogroup(own_marks.groupBy("of")).applyInPandas(place_heavy, shape)
    big = cut(big, "heavy")
    placed_big = big.join(comps.select("group_id", "size", "labels"), "group_id")
    held = {r["split"]: r["n"] for r in placed_big.groupBy("split").agg(F.sum("size").alias("n")).collect()}  # at most one row per split
    held_size = np.array([held.get(i, 0) for i in range(len(names))], dtype=float)
    held_label = placed_big.select("split", F.explode("labels").alias("_label", "n")).groupBy("_label").agg(*[F.coalesce(F.sum(F.when(F.col("split") == i, F.col("n"))), F.lit(0)).alias(f"h{i}") for i in range(len(names))])
    rest_marks = sums.where("rest > 0").join(held_label, "_label", "left").na.fill(0)

    def place(key: tuple, pdf: pd.DataFrame, marks: pd.DataFrame) -> pd.DataFrame:
        pdf, marks = pdf.sort_values("group_id"), marks.sort_values("_label")
        v = vectors(pdf, list(marks["_label"]))
        totals = np.array([total, *marks.total], dtype=float)
        holds = np.column_stack([held_size, marks[[f"h{i}" for i in range(len(names))]].to_numpy(dtype=float).T])
        part = v.sum(axis=0) / np.array([total - held_size.sum(), *marks.rest], dtype=float)
        want = (np.outer(share, totals) - holds) * part
        return pd.DataFrame({"group_id": pdf.group_id, "split": anneal(v, pdf.start.to_numpy(), want, seed + int(key[0]), scale=totals * part)})

    dealt = comps.where(~heavy).repartition(shards, "shard")  # so many tasks: adaptive execution would run small ones together
    dealt_marks = comps.where(~heavy).select(F.col("shard").alias("of"), F.explode(F.map_keys("labels")).alias("_label")).distinct().join(rest_marks, "_label").repartition(shards, "of")
    rest = dealt.groupBy("shard").cogroup(dealt_marks.groupBy("of")).applyInPandas(place, shape)
    placed = big.unionByName(rest)
    name = F.element_at(F.array(*[F.lit(x) for x in names]), F.col("split") + 1)
    return join_hot(keyed, placed, "group_id", id_col, comps.select("group_id", F.col("size").alias("n"))).select(id_col, "group_id", "n_objects", F.col("_label").alias("label"), name.alias("split"))


def spanning_groups(records: DataFrame, id_col: str = "image_id", object_col: str = "object_id", media_col: str = "media_id", label_col: str = "category_code") -> DataFrame:
    """(group_image_id, id): each record of each group of :func:`assign_splits` that spans two or more objects."""
    assigned = assign_splits(records, id_col, object_col, media_col, label_col)
    return assigned.where("n_objects > 1").select(F.col("group_id").alias("group_image_id"), id_col)


def label_report(assigned: DataFrame, ratios: tuple[float, ...] = RATIOS, names: tuple[str, ...] = SPLITS) -> DataFrame:
    """(label, split, target_share, records, share, deviation): how far each label is from its share of each split."""
    want = F.explode(F.array(*[F.struct(F.lit(n).alias("split"), F.lit(float(r)).alias("target_share")) for n, r in zip(names, ratios)])).alias("w")
    per = assigned.groupBy("label", "split").agg(F.count("*").alias("records"))
    whole = per.groupBy("label").agg(F.sum("records").alias("all")).select("label", "all", want).select("label", "all", "w.*")
    told = whole.join(per, ["label", "split"], "left").withColumn("records", F.coalesce("records", F.lit(0))).withColumn("share", F.col("records") / F.col("all"))
    return told.select("label", "split", "target_share", "records", "share", (F.col("share") - F.col("target_share")).alias("deviation"))


def split_report(assigned: DataFrame, ratios: tuple[float, ...] = RATIOS, names: tuple[str, ...] = SPLITS) -> DataFrame:
    """(split, target_share, records, groups, share)."""
    spark = assigned.sparkSession
    want = spark.createDataFrame(list(zip(names, map(float, ratios))), "split string, target_share double")
    per = assigned.groupBy("split", "group_id").agg(F.count("*").alias("n")).groupBy("split").agg(F.sum("n").alias("records"), F.count("*").alias("groups"))
    every = F.sum("records").over(Window.partitionBy(F.lit(1)))  # over one row per split
    return want.join(per, "split", "left").select("split", "target_share", F.coalesce("records", F.lit(0)).alias("records"), F.coalesce("groups", F.lit(0)).alias("groups"), F.coalesce(F.try_divide("records", every), F.lit(0.0)).alias("share"))
