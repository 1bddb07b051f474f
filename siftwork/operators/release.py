"""Joins with reasons, resumable logs, checksums, manifests and descriptors of a release."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.functions.keys import norm_key
from siftwork.functions.text import present

CONTROL_FILES = ("checksums.sha256", "release_manifest.json")


def gated_join(left: DataFrame, sides: Sequence[tuple[str, DataFrame]], key: str, gates: Sequence[tuple[str, Column]]) -> tuple[DataFrame, DataFrame]:
    """(kept, excluded counts): left joins on ``key``, then the first gate that a row fails is its reason. A side's repeated
    keys are the caller's to resolve first, e.g. by :func:`latest`."""
    joined = left
    for _, side in sides:
        joined = joined.join(side, key, "left")
    reason = F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in gates], F.lit(None).cast("string"))
    tagged = joined.withColumn("_reason", reason)
    return tagged.where("_reason IS NULL").drop("_reason"), tagged.where("_reason IS NOT NULL").groupBy(F.col("_reason").alias("reason")).agg(F.count("*").alias("n"))


def latest(log: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row of each key of an append-only log, by a partial aggregate."""
    names = log.columns
    return log.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*names), F.struct(*order, *[c for c in names if c not in order])).alias("_r")).select("_r.*")


def unresolved(wanted: DataFrame, log: DataFrame, key: str, order: Sequence[str], success: Column) -> DataFrame:
    """Rows of ``wanted`` whose latest log row isn't a success, or that have none: what a resumed run has to do."""
    done = latest(log, key, order).where(F.coalesce(success, F.lit(False))).select(key)
    return wanted.join(done, key, "left_anti")


def valid_success(attempts: DataFrame, files: DataFrame, success: Column, path: str = "file_name", size: str = "final_bytes") -> DataFrame:
    """Rows of ``attempts`` that are done: a success whose file is in ``files`` (path, length), with the expected size where
    one is known. A log alone doesn't tell whether its files are still there."""
    listed = files.select(F.col("path").alias("_path"), F.col("length").alias("_length"))
    there = attempts.where(F.coalesce(success, F.lit(False))).join(listed, F.col(path) == F.col("_path"))
    return there.where(F.col(size).isNull() | (F.col(size) == F.col("_length"))).select(*attempts.columns).distinct()


def completion(wanted: DataFrame, log: DataFrame, key: str, order: Sequence[str], success: Column) -> DataFrame:
    """(state, n): complete, failed and pending keys."""
    state = latest(log, key, order).select(key, F.when(F.coalesce(success, F.lit(False)), "complete").otherwise("failed").alias("state"))
    return wanted.select(key).distinct().join(state, key, "left").groupBy(F.coalesce("state", F.lit("pending")).alias("state")).agg(F.count("*").alias("n"))


def identity(columns: Sequence[str]) -> list[Column]:
    """Key parts in which a null equals the empty text."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_k{i}") for i, c in enumerate(columns)]


def reuse_split(selected: DataFrame, previous: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(reusable, to fetch): rows whose identity an earlier run has, and the others."""
    names = [f"_k{i}" for i in range(len(columns))]
    old = previous.select(*identity(columns)).distinct()
    with_key = selected.select("*", *identity(columns))
    return with_key.join(old, names, "left_semi").drop(*names), with_key.join(old, names, "left_anti").drop(*names)


def verified_reuse(selected: DataFrame, previous: DataFrame, columns: Sequence[str], sha: str) -> DataFrame:
    """``selected`` with ``verdict``: reuse where an earlier row of the same identity has the same checksum, mismatch where
    it has another one only, fetch where there is none. Checksums are compared without letter case and blanks."""
    names = [f"_k{i}" for i in range(len(columns))]
    old = previous.select(*identity(columns), norm_key(sha).alias("_old")).distinct()
    known = old.select(*names).distinct().withColumn("_known", F.lit(True))
    same = old.where("_old IS NOT NULL").withColumn("_same", F.lit(True))
    keyed = selected.select("*", *identity(columns), norm_key(sha).alias("_old"))
    verdict = F.when(F.col("_same"), "reuse").when(F.col("_known"), "mismatch").otherwise("fetch")
    return keyed.join(same, [*names, "_old"], "left").join(known, names, "left").withColumn("verdict", verdict).drop(*names, "_old", "_same", "_known")


def matching_resources(files: DataFrame, live: DataFrame, owner: str, path: str, changed: str) -> DataFrame:
    """(owner, changed) of the newest owner whose set of paths is exactly that of ``live``; ties to the lesser owner. Sets
    are compared by counts of their distinct members."""
    want = live.select(path).distinct()
    n = want.count()
    own = files.groupBy(owner, path).agg(F.max(changed).alias(changed)).join(want.withColumn("_hit", F.lit(1)), path, "left")
    per = own.groupBy(owner).agg(F.count("*").alias("_all"), F.count("_hit").alias("_hits"), F.max(changed).alias(changed))
    return per.where((F.col("_all") == n) & (F.col("_hits") == n)).orderBy(F.desc(changed), owner).limit(1).select(owner, changed)


def latest_ready(versions: DataFrame, key: str, version: str, ready: Column) -> DataFrame:
    """(key, version): the highest version that is ready."""
    return versions.where(F.coalesce(ready, F.lit(False))).groupBy(key).agg(F.max(version).alias(version))


def description_coverage(described: DataFrame) -> DataFrame:
    """(table, columns, present, exact) of :func:`described_columns` for each table, and for all under a null name."""
    return described.groupBy("table", "pos").agg(F.bool_or("present").alias("p"), F.bool_or("exact").alias("e")).rollup("table").agg(F.count("*").alias("columns"), F.count_if("p").alias("present"), F.count_if("e").alias("exact"))


def not_subset(part: DataFrame, whole: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Identities of ``part`` that ``whole`` lacks; empty for a subset."""
    names = [f"_k{i}" for i in range(len(columns))]
    return part.select(*identity(columns)).distinct().join(whole.select(*identity(columns)).distinct(), names, "left_anti")


def set_difference(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(side, n): keys that only one side has; both 0 where the sets are equal. One aggregate over both sides."""
    both = a.select(F.col(key).alias("k"), F.lit(1).alias("x")).unionAll(b.select(F.col(key).alias("k"), F.lit(2).alias("x")))
    per = both.groupBy("k").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    one = per.agg(F.count_if(F.col("hi") == 1).alias("left_only"), F.count_if(F.col("lo") == 2).alias("right_only"))
    return one.select(F.explode(F.array(F.struct(F.lit("left_only").alias("side"), F.col("left_only").alias("n")), F.struct(F.lit("right_only").alias("side"), F.col("right_only").alias("n")))).alias("x")).select("x.*")


def sequence_differences(a: DataFrame, b: DataFrame, pos: str, columns: Sequence[str]) -> DataFrame:
    """Positions at which two ordered tables differ, or that one lacks."""
    x = a.select(pos, F.struct(*columns).alias("a"))
    y = b.select(pos, F.struct(*columns).alias("b"))
    return x.join(y, pos, "full_outer").where(~F.col("a").eqNullSafe(F.col("b"))).select(pos)


def file_checksums(files: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of a ``binaryFile`` table."""
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def checksum_lines(sums: DataFrame, path: str = "path", sha: str = "sha256", skip: Sequence[str] = CONTROL_FILES) -> DataFrame:
    """Lines ``<sha256>  <path>`` sorted by path, control files left out."""
    return sums.where(~F.element_at(F.split(path, "/"), -1).isin(*skip)).orderBy(path).select(F.concat_ws("  ", sha, path).alias("value"))


def verify_checksums(lines: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, verdict): ok, mismatch or missing for each line; a line of another form is invalid and shown whole."""
    parts = F.split("value", "  ", 2)
    good = F.coalesce(F.col("value").rlike("^[0-9a-f]{64}  .+$"), F.lit(False))
    want = lines.where(present("value")).select(F.when(good, F.get(parts, 1)).otherwise(F.col("value")).alias("path"), F.when(good, F.get(parts, 0)).alias("want"))
    got = actual.select("path", F.col("sha256").alias("got"))
    verdict = F.when(F.col("want").isNull(), "invalid").when(F.col("got").isNull(), "missing").when(F.col("want") == F.col("got"), "ok").otherwise("mismatch")
    return want.join(got, "path", "left").select("path", verdict.alias("verdict"))


def artifact_manifest(expected: DataFrame, files: DataFrame) -> DataFrame:
    """(path, present, bytes, sha256) of every expected artifact."""
    return expected.select("path").distinct().join(file_checksums(files), "path", "left").select("path", F.col("sha256").isNotNull().alias("present"), "bytes", "sha256")


def settle_size(payload_bytes: int, render, most: int = 5) -> tuple[str, int]:
    """(text, total bytes) of a manifest that names the size of the release it is part of: rendered until the size it
    names no longer changes."""
    total = payload_bytes
    for _ in range(most):
        text = render(round(total / 1e9, 6))
        new = payload_bytes + len(text.encode())
        if new == total:
            return text, total
        total = new
    return render(round(total / 1e9, 6)), total


# Names of column types in a data package descriptor.
def descriptor_type(t: T.DataType) -> str:
    if isinstance(t, T.IntegralType):
        return "integer"
    return "numeric" if isinstance(t, T.FractionalType) else "string"


def descriptor(resources: Mapping[str, tuple[DataFrame, str]]) -> str:
    """JSON descriptor: each resource's path, description and column schema."""
    out = [{"path": p, "description": about, "schema": {"fields": [{"name": f.name, "type": descriptor_type(f.dataType), **({"description": f.metadata["comment"]} if "comment" in f.metadata else {})} for f in df.schema.fields]}} for p, (df, about) in resources.items()]
    return json.dumps({"resources": out}, ensure_ascii=False, indent=2)


def described_columns(documented: DataFrame, live: DataFrame) -> DataFrame:
    """(table, pos, documented, live, present, exact): documented columns beside the live ones at the same position.
    Both inputs: (table, pos, name, description)."""
    d = documented.select("table", "pos", F.col("name").alias("documented"), F.col("description").alias("_d"))
    v = live.select("table", "pos", F.col("name").alias("live"), F.col("description").alias("_v"))
    return d.join(v, ["table", "pos"], "full_outer").select("table", "pos", "documented", "live", present("_v").alias("present"), F.coalesce(F.col("_d") == F.col("_v"), F.lit(False)).alias("exact"))
