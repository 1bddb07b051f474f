"""Exact and near duplicates, and shared keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.values import hamming
from siftwork.operators.graph import connected_components, grouped_edges
from siftwork.operators.sampling import global_rank
from siftwork.session import cut, unsized


def _lists(df: DataFrame, key: str, sizes: DataFrame, **columns: str) -> DataFrame:
    """(key, one joined sorted list per column) of the groups that ``sizes`` has. A list is one cell, so the task that
    writes it holds the whole of it; the members as rows come from :func:`duplicate_groups`, :func:`shared_objects` and
    :func:`component_members`."""
    return df.join(sizes.select(key), key).groupBy(key).agg(*_joined(columns))


def _joined(columns: Mapping[str, str]) -> list[Column]:
    return [F.array_join(F.transform(F.array_sort(F.collect_set(c)), lambda x: x.cast("string")), "; ").alias(name) for name, c in columns.items()]


def merge_first_wins(inputs: Sequence[DataFrame], keys: Sequence[str], order: str) -> DataFrame:
    """Union of the inputs with one row per key: that of the earliest input, there the least ``order``. Null key parts
    equal the empty text. ``input`` tells where a row came from. A key's rows meet as one partial aggregate, not in a
    sorted window."""
    tagged = [df.withColumn("input", F.lit(i)) for i, df in enumerate(inputs)]
    every = tagged[0]
    for df in tagged[1:]:
        every = every.unionByName(df, allowMissingColumns=True)
    names = every.columns
    key = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}") for i, k in enumerate(keys)]
    best = every.groupBy(*key).agg(F.min_by(F.struct(*names), F.struct("input", order)).alias("_r"))
    return best.select("_r.*")


def merge_report(inputs: Sequence[DataFrame], keys: Sequence[str], order: str) -> DataFrame:
    """(input, read, kept, skipped)."""
    kept = merge_first_wins(inputs, keys, order).groupBy("input").agg(F.count("*").alias("kept"))
    reads = None
    for i, df in enumerate(inputs):
        one = df.agg(F.count("*").alias("read")).select(F.lit(i).alias("input"), "read")
        reads = one if reads is None else reads.unionByName(one)
    return reads.join(kept, "input", "left").select("input", "read", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("read") - F.coalesce("kept", F.lit(0))).alias("skipped"))


def duplicate_pairs(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows after the first of each key pair, blank pairs included; the first is the one with the least ``order``."""
    key = [F.coalesce(F.col(k).cast("string"), F.lit("")).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    with_key = df.select("*", *key)
    first = with_key.groupBy(*names).agg(F.min(order).alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return with_key.join(first, names).where(F.col(order) > F.col("_first")).drop(*names, "_first")


def _shared_triples(df: DataFrame, key: str, object_col: str, unit_col: str) -> DataFrame:
    ok = df.where((F.coalesce(F.trim(key), F.lit("")) != "") & (F.coalesce(F.trim(object_col), F.lit("")) != ""))
    return ok.groupBy(key, object_col, unit_col).agg(F.count("*").alias("n"))


def _shared_sizes(triples: DataFrame, key: str, object_col: str) -> DataFrame:
    pairs = triples.groupBy(key, object_col).agg(F.sum("n").alias("n"))
    return pairs.groupBy(key).agg(F.count("*").alias("object_count"), F.sum("n").alias("row_count")).where("object_count > 1")


def shared_keys(df: DataFrame, key: str, object_col: str, unit_col: str) -> DataFrame:
    """Keys that stand with more than one distinct object: (key, object_count, row_count, objects, units), lists sorted.
    Blank keys and objects are skipped."""
    triples = _shared_triples(df, key, object_col, unit_col)
    sizes = _shared_sizes(triples, key, object_col)
    return sizes.join(_lists(triples, key, sizes, objects=object_col, units=unit_col), key).select(key, "object_count", "row_count", "objects", "units")


def shared_objects(df: DataFrame, key: str, object_col: str, unit_col: str) -> DataFrame:
    """(key, object, unit, n): the same as rows, one for each key, object and unit, with its count of rows."""
    triples = _shared_triples(df, key, object_col, unit_col)
    return triples.join(_shared_sizes(triples, key, object_col).select(key), key, "left_semi").select(key, object_col, unit_col, "n")


def flag_members(df: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """``df`` with ``flag`` true where the row's key is among ``keys``."""
    known = keys.select(key).distinct().withColumn("_hit", F.lit(True))
    return df.join(known, key, "left").withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_hit")


def exact_duplicates(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """(key, id, kept_id) for every row but the one with the least id of its key; blank keys are skipped."""
    ok = df.where(F.coalesce(F.trim(key), F.lit("")) != "").select(key, id_col)
    first = ok.groupBy(key).agg(F.min(id_col).alias("kept_id"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return ok.join(first, key).where(F.col(id_col) > F.col("kept_id")).select(key, id_col, "kept_id")


def duplicate_groups(df: DataFrame, key: str, id_col: str) -> DataFrame:
    """Every member of each group of two or more equal keys: (key, id, group_size)."""
    ok = df.where(F.coalesce(F.trim(key), F.lit("")) != "").select(key, id_col)
    size = ok.groupBy(key).agg(F.count("*").alias("group_size")).where("group_size > 1")
    return ok.join(size, key).select(key, id_col, "group_size")


def grouped_ids(df: DataFrame, key: str, id_col: str, object_col: str) -> DataFrame:
    """Groups of two or more rows with one key: (key, n, ids, objects), ids and distinct objects sorted and joined."""
    ok = df.where(F.coalesce(F.trim(key), F.lit("")) != "")
    sizes = ok.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
    return sizes.join(_lists(ok, key, sizes, ids=id_col, objects=object_col), key).select(key, "n", "ids", "objects")


#: Codes that share a set of pieces before it is split further.
HOT = 20_000


def hamming_scheme(codes: int, max_distance: int, bits: int = 64) -> tuple[list[tuple[int, int]], list[tuple[int, ...]]]:
    """(pieces as (shift, width), sets of pieces): if two codes differ in at most ``max_distance`` bits, they agree in all
    pieces of one of the sets. More and smaller pieces mean more sets, each with more bits; the number of pieces is the one
    with the least keys and expected chance matches per code, so both grow slower than the number of codes."""
    best = None
    for k in range(max_distance + 1, max_distance + 7):
        edges = [round(bits * i / k) for i in range(k + 1)]
        pieces = [(a, b - a) for a, b in zip(edges, edges[1:])]
        sets = list(combinations(range(k), k - max_distance))
        cost = sum(1 + codes / 2.0 ** sum(pieces[i][1] for i in own) for own in sets)
        if best is None or cost < best[0]:
            best = cost, pieces, sets
    return best[1], best[2]


def piece_of(h: Column, shift: int, width: int) -> Column:
    return F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << width) - 1 if width < 64 else -1))


def piece_key(h: Column, pieces: Sequence[tuple[int, int]], own: Sequence[int]) -> Column:
    """The bits of a set of pieces as one number."""
    out = F.lit(0).cast("bigint")
    for i in own:
        out = F.shiftleft(out, pieces[i][1] % 64).bitwiseOR(piece_of(h, *pieces[i]))
    return out


def part_masks(pieces: Sequence[tuple[int, int]], own: Sequence[int], n: int) -> list[int]:
    """Masks of ``n`` nearly equal parts of the bits that are not in a set of pieces."""
    rest = [b for k, (shift, width) in enumerate(pieces) if k not in own for b in range(shift, shift + width)]
    edges = [round(len(rest) * m / n) for m in range(n + 1)]
    return [sum(1 << b for b in rest[edges[m] : edges[m + 1]]) for m in range(n)]


def signed(m: int) -> int:
    return m - (1 << 64) if m >> 63 else m


def _near_codes(codes: DataFrame, max_distance: int) -> DataFrame:
    """(h1, h2, distance) of distinct codes ``h`` that differ in at most ``max_distance`` bits, h1 below h2; see :func:`hamming_pairs`."""
    pieces, sets = hamming_scheme(codes.count(), max_distance)
    keyed = codes.select("h", F.posexplode(F.array(*[piece_key(F.col("h"), pieces, own) for own in sets])).alias("p", "x"))
    hot = cut(keyed.groupBy("p", "x").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select("p", "x"), "hot")
    masks = [[signed(m) for m in part_masks(pieces, own, max_distance + 1)] for own in sets]
    part = lambda h, m: h.bitwiseAND(F.element_at(F.array(*[F.lit(own[m]).cast("bigint") for own in masks]), F.col("p") + 1))
    none = F.array(F.struct(F.lit(-1).alias("m"), F.lit(0).cast("bigint").alias("s")))
    split = none
    if not hot.isEmpty():
        parts = F.array(*[F.struct(F.lit(m).alias("m"), part(F.col("h"), m).alias("s")) for m in range(max_distance + 1)])
        keyed = keyed.join(hot.withColumn("hot", F.lit(True)), ["p", "x"], "left")
        split = F.when(F.col("hot").isNotNull(), parts).otherwise(none)
    keyed = keyed.select("h", "p", "x", F.explode(split).alias("k")).select("h", "p", "x", "k.m", "k.s")
    near = keyed.withColumnRenamed("h", "h1").join(unsized(keyed.withColumnRenamed("h", "h2")), ["p", "x", "m", "s"]).where("h1 < h2")
    first_part = F.coalesce(*[F.when(part(F.col("h1").bitwiseXOR(F.col("h2")), m) == 0, F.lit(m)) for m in range(max_distance + 1)])
    near = near.where((F.col("m") == -1) | (F.col("m") == first_part))
    near = near.withColumn("distance", hamming("h1", "h2")).where(F.col("distance") <= max_distance)
    agree = [piece_of(F.col("h1"), *piece) == piece_of(F.col("h2"), *piece) for piece in pieces]
    first = F.coalesce(*[F.when(reduce(lambda x, y: x & y, [agree[i] for i in own]), F.lit(n)) for n, own in enumerate(sets)])
    return near.where(F.col("p") == first).select("h1", "h2", "distance")


def hamming_pairs(df: DataFrame, id_col: str, bits_col: str, max_distance: int = 4, other: str | None = None) -> DataFrame:
    """(a, b, distance) of rows whose 64-bit codes differ in at most ``max_distance`` bits, a below b; where ``other`` is
    given, pairs with equal ``other`` are left out.

    Exact by the pigeonhole principle: codes are joined on each set of pieces that :func:`hamming_scheme` picks for their
    number. A set that more than HOT codes share is split once more: the other bits make ``max_distance + 1`` parts, of
    which one must agree too. The join runs on distinct codes, and a pair is kept only by the first set that agrees; rows
    with equal codes are expanded at the end. Null codes match nothing.
    """
    rows = df.where(F.col(bits_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(bits_col).alias("h"), *([F.col(other).alias("o")] if other else [])).distinct()
    codes = rows.select("h").distinct()
    near = _near_codes(codes, max_distance)
    near = near.unionByName(codes.select(F.col("h").alias("h1"), F.col("h").alias("h2"), F.lit(0).alias("distance")))
    side = lambda n: rows.select(F.col("h").alias(f"h{n}"), F.col("id").alias(f"i{n}"), *([F.col("o").alias(f"o{n}")] if other else []))
    both = near.join(unsized(side(1)), "h1").join(unsized(side(2)), "h2").where("h1 <> h2 OR i1 < i2")
    if other:
        both = both.where(~F.col("o1").eqNullSafe(F.col("o2")))
    return both.select(F.least("i1", "i2").alias("a"), F.greatest("i1", "i2").alias("b"), F.col("distance").cast("int").alias("distance"))


def hamming_edges(df: DataFrame, id_col: str, bits_col: str, max_distance: int = 4, other: str | None = None) -> DataFrame:
    """(a, b) with the same connected components as the pairs of :func:`hamming_pairs`, but at most one edge for each row
    and each pair of near codes: the rows of one code in n copies have n - 1 edges here and n * (n - 1) / 2 pairs there.

    Rows of one code with two or more ``other`` are all joined by pairs. Rows of one code and one ``other`` are joined by
    any near code with another ``other``, since each of them pairs with a row of it. So every code needs its least id,
    whether its ``other`` is one, and which; equal rows needn't be taken out first."""
    same = F.coalesce(F.concat(F.lit("="), F.col(other).cast("string")), F.lit("")) if other else F.col(id_col)
    rows = df.where(F.col(bits_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(bits_col).alias("h"), same.alias("o"))
    codes = rows.groupBy("h").agg(F.min("id").alias("first"), F.min("o").alias("o"), (F.min("o") != F.max("o")).alias("many"))
    codes = cut(codes.select("h", "first", "many", F.when(~F.col("many"), F.col("o")).alias("o")), "codes")
    side = lambda n: unsized(codes.select(*[F.col(c).alias(f"{c}{n}") for c in codes.columns]))
    both = _near_codes(codes.select("h"), max_distance).join(side(1), "h1").join(side(2), "h2")
    links = both.where("many1 OR many2 OR o1 <> o2").select("h1", "h2", "first1", "first2")
    return grouped_edges(rows.select("id", "h"), codes.where("many").select("h", "first"), links)


def near_components(pairs: DataFrame, members: DataFrame, id_col: str, object_col: str, **lists: str) -> DataFrame:
    """(group_id, first_id, size, object_count, ids, *lists): the components of near pairs, the largest first, then by
    least id. ``lists`` names further columns of ``members``, each given as its distinct values, null as the empty text,
    sorted and joined. Components of every size have their lists."""
    comp = connected_components(pairs).withColumnRenamed("node", id_col)
    more = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{name}") for name, c in lists.items()]
    named = unsized(comp).join(members.select(id_col, object_col, *more).dropDuplicates([id_col]), id_col).withColumnRenamed("component", "first_id")
    pairs = named.groupBy("first_id", object_col).agg(F.count("*").alias("n"))
    sizes = pairs.groupBy("first_id").agg(F.sum("n").alias("size"), F.count(object_col).alias("object_count"))
    joined = named.groupBy("first_id").agg(*_joined({"ids": id_col} | {name: f"_{name}" for name in lists}))
    per = unsized(sizes).join(joined, "first_id")
    ranked = global_rank(per.withColumn("_less", -F.col("size")), ["_less", "first_id"], "group_id")
    return ranked.select("group_id", "first_id", "size", "object_count", "ids", *lists)


def component_members(pairs: DataFrame) -> DataFrame:
    """(first_id, id): every member of each component of near pairs as a row, the least member as its first."""
    return connected_components(pairs).select(F.col("component").alias("first_id"), F.col("node").alias("id"))
