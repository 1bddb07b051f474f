"""Mixing sources to target weights.

Method: the tokens of each source are packed into blocks of a fixed length; source counts are drawn for each output
shard, multinomially with the totals held; each slot is mapped through a pseudorandom permutation of its source's block
numbers, one for each pass over the source, and joined with its block by number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwork.functions.keys import norm_key
from siftwork.llm import tokens
from siftwork.session import Spool, cut

BLOCK = 1024
#: Slots of an output shard, and output shards at most; with more slots the shards grow.
SHARD_SLOTS, SHARDS = 256, 10_000
#: Hash buckets over which a source's running token count is carried: at least so many, and so many that a bucket of the
#: largest source has about BUCKET_ROWS documents. The order of the documents doesn't depend on them.
BUCKETS, BUCKET_ROWS = 1024, 20_000


def token_counts(documents: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, src, n_tokens): the size of every document's whole text and its normalised source. Null texts have 0
    tokens."""
    where = path or tokens.vocabulary_path()

    @F.pandas_udf("bigint")
    def size(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([tokens.count(t, where) for t in texts], dtype="int64")

    return documents.select("doc_id", norm_key("source").alias("src"), size("text").alias("n_tokens"))


def mix_plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(mix_id, mix_name, source, target_share, max_repeats, budget_tokens, available, wanted, capacity, reached, goal):
    ``reached`` is false where all tokens of the source times ``max_repeats`` are less than ``target_share *
    budget_tokens``; ``goal`` is the whole number of tokens to draw, the next above ``wanted`` where the source has them, so
    what is drawn is less than ``wanted`` exactly where the source can't reach it. A source that no document has has 0
    tokens; a null ``max_repeats`` counts as 1."""
    per = sizes.where("src IS NOT NULL").groupBy("src").agg(F.sum("n_tokens").alias("available"))
    want = targets.where("mix_id IS NOT NULL").select("mix_id", "mix_name", norm_key("source").alias("src"), "target_share", F.coalesce("max_repeats", F.lit(1)).alias("max_repeats"), "budget_tokens").distinct()
    plan = want.join(per, "src", "left").withColumn("available", F.coalesce("available", F.lit(0)).cast("bigint"))
    wanted = F.col("target_share") * F.col("budget_tokens")
    capacity = F.col("available") * F.col("max_repeats")
    return plan.select("mix_id", "mix_name", F.col("src").alias("source"), "target_share", "max_repeats", "budget_tokens", "available", wanted.alias("wanted"), capacity.alias("capacity"), (capacity >= wanted).alias("reached"), F.least(capacity, F.ceil(wanted)).cast("bigint").alias("goal"))


def pack(sizes: DataFrame, seed: int = 5, block: int = BLOCK) -> DataFrame:
    """(src, block, at, doc_id, first, length): the stretches of documents that fill each block. A source's documents follow
    each other in the order of a hash; ``at`` is the place in the block, ``first`` the token in the document. Running
    counts are carried over hash buckets, so no source is ordered in one task."""
    own = sizes.where("src IS NOT NULL AND n_tokens > 0 AND doc_id IS NOT NULL").withColumn("h", F.xxhash64(F.lit(seed), "doc_id"))
    most = own.groupBy("src").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bits = max(BUCKETS, -(-most // BUCKET_ROWS)).bit_length() - 1 + (most > BUCKETS * BUCKET_ROWS)
    own = own.withColumn("bucket", F.shiftrightunsigned("h", 64 - bits))
    sums = own.groupBy("src", "bucket").agg(F.sum("n_tokens").alias("sum"))
    before = F.coalesce(F.sum("sum").over(Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = sums.select("src", "bucket", before.alias("base"))
    inner = F.sum("n_tokens").over(Window.partitionBy("src", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    placed = own.withColumn("inner", inner).join(base, ["src", "bucket"]).select("src", "doc_id", "n_tokens", (F.col("base") + F.col("inner")).alias("o"))
    spread = placed.select("src", "doc_id", "n_tokens", "o", F.explode(F.sequence(F.expr(f"o div {block}"), F.expr(f"(o + n_tokens - 1) div {block}"))).alias("block"))
    start, stop = F.greatest("o", F.col("block") * block), F.least(F.col("o") + F.col("n_tokens"), (F.col("block") + 1) * block)
    return spread.select("src", "block", (start - F.col("block") * block).alias("at"), "doc_id", (start - F.col("o")).alias("first"), (stop - start).alias("length"))


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..size-1 for each key, taken at ``index``: four Feistel rounds over the least even
    number of bits that holds ``size``, walked until the value is below it."""
    size = size.astype(np.uint64)
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2).astype(np.float64) + 0.5)).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    x, todo = index.astype(np.uint64), np.ones(len(index), dtype=bool)
    while todo.any():
        left, right, h, m, k = x[todo] >> half[todo], x[todo] & mask[todo], half[todo], mask[todo], key[todo].astype(np.uint64)
        for r in range(4):
            f = (right + k + np.uint64((0x9E3779B97F4A7C15 * (r + 1)) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
            f ^= f >> np.uint64(31)
            f *= np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((f >> np.uint64(29)) & m)
        x[todo] = (left << h) | right
        todo = x >= size
    return x.astype(np.int64)


SHARDED = "mix_id bigint, mix_name string, source string, shard int, start bigint, n bigint, available bigint, goal bigint"


def _shards(plan: DataFrame, block: int, seed: int) -> DataFrame:
    """(mix_id, mix_name, source, shard, first slot, slots, available, goal): how many slots each output shard takes of
    each source. Drawing without replacement from the slots that are left is the multinomial draw with the totals held.
    The driver holds the sources of one mix at a time."""
    out = Spool(plan.sparkSession, "shards", SHARDED)
    rows: list = []
    wanted = plan.where("goal > 0").orderBy("mix_name", "mix_id").toLocalIterator()
    for r in wanted:
        if rows and r["mix_name"] != rows[0]["mix_name"]:
            _deal(rows, out, block, seed)
            rows = []
        rows.append(r)
    if rows:
        _deal(rows, out, block, seed)
    return out.table()


def _deal(rows: list, out: Spool, block: int, seed: int) -> None:
    slots = np.array([(r["goal"] // r["available"]) * -(-r["available"] // block) + -(-(r["goal"] % r["available"]) // block) for r in rows], dtype=np.int64)
    rng = np.random.default_rng([seed, rows[0]["mix_id"]])
    left, given = slots.copy(), np.zeros_like(slots)
    per = max(SHARD_SLOTS, -(-int(slots.sum()) // SHARDS))
    shard = 0
    while left.sum():
        took = rng.multivariate_hypergeometric(left, min(per, int(left.sum())), method="marginals")
        out.add([(r["mix_id"], r["mix_name"], r["source"], shard, int(g), int(t), r["available"], r["goal"]) for r, g, t in zip(rows, given, took) if t])
        given, left, shard = given + took, left - took, shard + 1


def draw_mix(documents: DataFrame, targets: DataFrame, seed: int = 5, block: int = BLOCK, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(plan, mix). plan is that of :func:`mix_plan`; mix: (mix_id, mix_name, source, shard, slot, pass, block, at, doc_id,
    first_token, last_token), the stretches of documents that make each mix, in slots of ``block`` tokens.

    Each source gets ``target_share * budget_tokens`` tokens, rounded up, or all it may give; passes after the first
    repeat it, never more than ``max_repeats`` times. Sources are compared without letter case and blanks; documents without a source, a text or an id take no part; a repeated row counts as another document.
    """
    sizes = cut(token_counts(documents, path), "token-counts")
    plan = cut(mix_plan(sizes, targets), "plan")
    counts = _shards(plan, block, seed)
    per_pass = F.expr(f"(available + {block - 1}) div {block}")
    slots = counts.repartition("mix_id", "shard").select("mix_id", "mix_name", "source", "shard", "available", "goal", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("k"))
    slots = slots.withColumn("pass", F.expr(f"k div ((available + {block - 1}) div {block})")).withColumn("i", F.col("k") % per_pass)

    @F.pandas_udf("bigint")
    def place(i: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
        full = size.to_numpy() // block  # a short last block keeps its place at the end of each pass
        out = i.to_numpy().copy()
        inner = out < full
        if inner.any():
            out[inner] = permute(out[inner], full[inner], key.to_numpy()[inner])
        return pd.Series(out)

    slots = slots.withColumn("block", place("i", "available", F.xxhash64(F.lit(seed), "mix_id", "source", "pass")))
    rest = F.col("goal") - F.col("pass") * F.col("available") - F.col("i") * block  # tokens still wanted at this slot
    slots = slots.select("mix_id", "mix_name", "source", "shard", F.col("k").alias("slot"), "pass", "block", rest.alias("rest"))
    joined = slots.join(pack(sizes, seed, block).withColumnRenamed("src", "source"), ["source", "block"]).where("at < rest")
    mix = joined.select("mix_id", "mix_name", "source", "shard", "slot", "pass", "block", "at", "doc_id", F.col("first").alias("first_token"), (F.col("first") + F.least("length", F.col("rest") - F.col("at"))).alias("last_token"))
    return plan, mix


def mix_report(documents: DataFrame, targets: DataFrame, path: str | None = None) -> DataFrame:
    """(mix_id, mix_name, source, target_share, wanted, tokens, actual_share, most_repeats, reached): what was drawn for
    each target; ``reached`` is whether that is all of ``wanted``."""
    plan, mix = draw_mix(documents, targets, path=path)
    got = mix.groupBy("mix_id").agg(F.sum(F.col("last_token") - F.col("first_token")).alias("tokens"), (F.max("pass") + 1).alias("most_repeats"))
    whole = F.sum("tokens").over(Window.partitionBy("mix_name"))  # over the targets of one mix
    told = plan.join(got, "mix_id", "left").withColumn("tokens", F.coalesce("tokens", F.lit(0)))
    return told.select("mix_id", "mix_name", "source", "target_share", "wanted", "tokens", F.coalesce(F.try_divide("tokens", whole), F.lit(0.0)).alias("actual_share"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"), (F.col("tokens") >= F.col("wanted")).alias("reached"))


def unreachable(documents: DataFrame, targets: DataFrame, path: str | None = None) -> DataFrame:
    """(mix_id): the targets for which the mix, once drawn, has less than was wanted."""
    return mix_report(documents, targets, path).where(~F.col("reached")).select("mix_id").distinct()
