"""Same or near-same records across splits.

Method: the normalised keys of a record (digest, object, pieces of the perceptual hash) are its passages. The evaluation
passages are dealt to shards by hash and form an Aho-Corasick automaton in each, which scans the training passages that
could be in it. Matched stretches of an evaluation record are merged over all training records into its coverage, and a
popcount decides on hashes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwork.functions.keys import norm_key, one_row_per
from siftwork.operators.dedup import hamming_scheme, part_masks, piece_key, signed
from siftwork.session import cut

MAX_DISTANCE = 4
#: Passages of one automaton, about.
SHARD = 150_000
#: A set of pieces shared by more hashes than this is hot: there, a hash is filed under each fifth of its other bits as
#: well, of which one must agree too, as four bits can't break five fifths.
HOT, FIFTHS = 20_000, MAX_DISTANCE + 1
#: Hex digits of a perceptual hash.
DIGITS = 16


def bits(hex16: Column) -> Column:
    """16 hex digits as a signed 64-bit integer; null for anything else."""
    h = norm_key(hex16)
    return F.when(h.rlike("^[0-9a-f]{16}$"), F.conv(h, 16, -10).cast("bigint"))


def split_records(metadata: DataFrame, splits: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """(image_id, sha, ph, obj, split, is_eval, ...extra): a row per distinct image that has a known split, keys
    normalised, blank ones null."""
    known = ["sha", "ph", "obj", *extra]
    rec = one_row_per(metadata.select("image_id", norm_key("sha256").alias("sha"), bits(F.col("phash")).alias("ph"), norm_key("object_id").alias("obj"), *extra), "image_id", known)
    part = one_row_per(splits.select("image_id", norm_key("split").alias("split")), "image_id", ["split"]).where(F.col("split").isin("train", "validation", "test"))
    return rec.join(part, "image_id").withColumn("is_eval", F.col("split") != "train")


def _passages(rec: DataFrame, scheme: tuple[list, list]) -> DataFrame:
    """(text, ph, is_eval), distinct: partial aggregation leaves a key with a third of all rows as one row per map task,
    and one or two in all."""
    pieces, sets = scheme
    whole = [
        rec.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("key"), "is_eval").agg(F.lit(1).alias("one")).select(F.concat(F.lit(kind), F.col("key")).alias("text"), F.lit(None).cast("bigint").alias("ph"), "is_eval")
        for kind, c in (("s", "sha"), ("o", "obj"))
    ]
    hashes = rec.where("ph IS NOT NULL").select("ph", "is_eval").distinct()
    near = hashes.select(F.posexplode(F.array(*[piece_key(F.col("ph"), pieces, own) for own in sets])).alias("n", "v"), "ph", "is_eval")
    hot = cut(near.groupBy("n", "v").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select("n", "v"), "hot")
    text = F.concat_ws(":", F.lit("p"), F.col("n").cast("string"), F.hex("v"))
    if hot.isEmpty():
        near = near.select(text.alias("text"), "ph", "is_eval")
    else:  # the sets of pieces of a hash, over HOT, make a row of ``hot`` at most; the join picks its own way
        near = near.join(hot.withColumn("hot", F.lit(True)), ["n", "v"], "left")
        masks = [part_masks(pieces, own, FIFTHS) for own in sets]
        fifths = F.array(*[F.concat(F.lit(f"~{m}"), F.hex(F.col("ph").bitwiseAND(F.element_at(F.array(*[F.lit(signed(own[m])).cast("bigint") for own in masks]), F.col("n") + 1)))) for m in range(FIFTHS)])
        more = F.explode(F.when(F.col("hot").isNotNull(), fifths).otherwise(F.array(F.lit("")))).alias("more")
        near = near.select(text.alias("text"), more, "ph", "is_eval").select(F.concat("text", "more").alias("text"), "ph", "is_eval")
    return whole[0].unionByName(whole[1]).unionByName(near)


def scan_shard(pdf: pd.DataFrame, scheme: tuple[list, list], max_distance: int = MAX_DISTANCE) -> pd.DataFrame:
    """Scan one shard. Whole keys match when the automaton finds them; hashes when a set of pieces agrees and at most
    ``max_distance`` bits differ. A pair of hashes is returned only by the first set of pieces that agrees and, in a hot
    one, by the first fifth that does."""
    import ahocorasick

    pieces, sets = scheme
    ev, tr = pdf[pdf.is_eval], pdf[~pdf.is_eval]
    out: list[tuple] = []
    names = ["kind", "key", "ph_train", "ph_eval", "distance"]
    if not len(ev) or not len(tr):
        return pd.DataFrame(out, columns=names)
    passages: dict[str, list[int]] = {}
    for text, ph in zip(ev.text, ev.ph_text):
        passages.setdefault(text, []).append(int(ph) if ph else 0)
    auto = ahocorasick.Automaton()
    for text, hashes in passages.items():
        auto.add_word("\n" + text + "\n", (text, np.array(hashes, dtype=np.int64) if text[0] == "p" else None))
    auto.make_automaton()
    train: dict[str, list[int]] = {}
    for text, ph in zip(tr.text, tr.ph_text):
        train.setdefault(text, []).append(int(ph) if ph else 0)
    corpus = "\n" + "\n\n".join(train) + "\n"
    masks = [sum(((1 << pieces[i][1]) - 1) << pieces[i][0] for i in own) for own in sets]
    for _, (text, hashes) in auto.iter(corpus):
        if hashes is None:
            out.append((text[0], text[1:], 0, 0, 0))
            continue
        place, _, fifth = text.partition("~")
        own = int(place.split(":")[1])
        fifths = part_masks(pieces, sets[own], FIFTHS) if fifth else []
        for h in train[text]:
            x = (hashes ^ np.int64(h)).view(np.uint64)
            d = np.bitwise_count(x)
            for e, diff, dist in zip(hashes[d <= max_distance].tolist(), x[d <= max_distance].tolist(), d[d <= max_distance].tolist()):
                if next(n for n, m in enumerate(masks) if not diff & m) != own:
                    continue
                if not fifth or next(n for n, m in enumerate(fifths) if not diff & m) == int(fifth[0]):
                    out.append(("p", "", h, e, dist))
    return pd.DataFrame(out, columns=names)


def matched_keys(rec: DataFrame) -> DataFrame:
    """(kind, key, ph_train, ph_eval, distance): every key that stands in train and in an evaluation split, and every pair
    of hashes of the two sides within four bits."""
    records = rec.count()
    scheme = hamming_scheme(records, MAX_DISTANCE)
    passages = _passages(rec, scheme).withColumn("ph_text", F.col("ph").cast("string"))
    shards = max(1, -(-records * (2 + len(scheme[1])) // SHARD))  # by the passages before repeated keys are merged
    sharded = passages.withColumn("shard", F.pmod(F.xxhash64("text"), F.lit(shards)).cast("int"))
    shape = "kind string, key string, ph_train bigint, ph_eval bigint, distance int"
    sharded = sharded.select("shard", "text", "ph_text", "is_eval").repartition(shards, "shard")  # so many tasks, whatever the session's setting
    return sharded.groupBy("shard").applyInPandas(lambda p: scan_shard(p, scheme), shape)


def _equal_digits(a: str, b: str) -> Column:
    """The hex digits in which two hashes agree, as a bit mask."""
    x = F.col(a).bitwiseXOR(F.col(b))
    bits_of = [F.when(F.shiftrightunsigned(x, 4 * i).bitwiseAND(F.lit(15)) == 0, F.lit(1 << i)).otherwise(F.lit(0)) for i in range(DIGITS)]
    return sum(bits_of[1:], bits_of[0]).cast("int")


def _coverage(sha: Column, digits: Column, obj: Column) -> Column:
    """Part of an evaluation record's text, its digest, hash and object in a row, that is matched: stretches merged."""
    size = [F.coalesce(F.length("sha"), F.lit(0)), F.when(F.col("ph").isNotNull(), DIGITS).otherwise(0), F.coalesce(F.length("obj"), F.lit(0))]
    covered = F.when(sha, size[0]).otherwise(0) + F.bit_count(digits) + F.when(obj, size[2]).otherwise(0)
    return covered.cast("double") / (size[0] + size[1] + size[2])


def overlaps(metadata: DataFrame, splits: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records, pairs). pairs: (train_id, eval_id, kinds, distance, digits), one row per pair of a training and an
    evaluation record with equal sha256 or object_id, or phash values at most 4 bits apart. ``kinds`` has an s, o or p for
    each of these; ``digits`` masks the hex digits of the phash that agree, where it has a p.

    Ids and digests are compared without letter case and blanks; null, blank and (for phash) malformed ones match
    nothing. Images without a known split, or not in metadata, take no part; copies of an image count once. Matching
    runs on distinct keys; only matched keys are expanded to records, each pair being a row of the result.
    """
    rec = cut(split_records(metadata, splits), "split-records")
    hits = cut(matched_keys(rec), "hits")
    train = rec.where(~F.col("is_eval")).select(F.col("image_id").alias("train_id"), "sha", "obj", "ph")
    held = rec.where("is_eval").select(F.col("image_id").alias("eval_id"), "sha", "obj", "ph")
    cols = ["train_id", "eval_id", "kind", "distance", "digits"]

    def by(kind: str, key: str) -> DataFrame:
        k = hits.where(F.col("kind") == kind).select("kind", "key", F.lit(None).cast("int").alias("distance"), F.lit(0).alias("digits"))
        return held.select("eval_id", F.col(key).alias("key")).join(k, "key").join(train.select("train_id", F.col(key).alias("key")), "key").select(*cols)

    near = hits.where("kind = 'p'").select("kind", "ph_train", "ph_eval", "distance", _equal_digits("ph_train", "ph_eval").alias("digits"))
    near = near.join(held.select("eval_id", F.col("ph").alias("ph_eval")), "ph_eval").join(train.select("train_id", F.col("ph").alias("ph_train")), "ph_train").select(*cols)
    every = by("s", "sha").unionByName(by("o", "obj")).unionByName(near)
    pairs = every.groupBy("train_id", "eval_id").agg(F.array_join(F.array_sort(F.collect_set("kind")), "").alias("kinds"), F.max("distance").alias("distance"), F.bit_or("digits").alias("digits"))
    return rec, pairs


def evaluation_coverage(metadata: DataFrame, splits: DataFrame) -> DataFrame:
    """(image_id, split, train_records, kinds, coverage): each evaluation record that overlaps train, with how many training
    records do and how much of its text, digest, hash and object, stands in any of them."""
    rec, pairs = overlaps(metadata, splits)
    has = lambda k: F.contains("kinds", F.lit(k))
    per = pairs.groupBy(F.col("eval_id").alias("image_id")).agg(F.count("*").alias("train_records"), *[F.bool_or(has(k)).alias(k) for k in "ops"], F.bit_or("digits").alias("digits"))
    kinds = F.concat(*[F.when(F.col(k), k).otherwise("") for k in "ops"]).alias("kinds")
    return rec.join(per, "image_id").select("image_id", "split", "train_records", kinds, _coverage(F.col("s"), F.col("digits"), F.col("o")).alias("coverage"))


def overlap_report(metadata: DataFrame, splits: DataFrame) -> DataFrame:
    """(split, institution, records, overlapping, pairs): per evaluation split and institution. Institutions are compared
    without letter case and blanks; null ones are shown as empty."""
    rec, pairs = overlaps(metadata, splits)
    names = one_row_per(metadata.select("image_id", F.coalesce(norm_key("institution"), F.lit("")).alias("institution")), "image_id", ["institution"])
    held = rec.where("is_eval").select(F.col("image_id").alias("eval_id"), "split").join(names.withColumnRenamed("image_id", "eval_id"), "eval_id")
    per = pairs.groupBy("eval_id").agg(F.count("*").alias("n"))
    return held.join(per, "eval_id", "left").groupBy("split", "institution").agg(F.count("*").alias("records"), F.count("n").alias("overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"))
