"""Sinks. A folder is written whole or not at all; nothing is overwritten unless told so."""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def routed(df: DataFrame, path: str, column: str, values: Sequence[str], overwrite: bool = False) -> dict[str, str]:
    """The whole table under ``all`` and one table per value, empty ones included, each with the full schema."""
    mode = "overwrite" if overwrite else "errorifexists"
    where = {"all": f"{path}/all"} | {v: f"{path}/{v}" for v in values}
    zstd_parquet(df, where["all"], mode)
    stored = df.sparkSession.read.schema(df.schema).parquet(where["all"])
    for v in values:
        zstd_parquet(stored.where(F.col(column) == v), where[v], mode)
    return where


def zstd_parquet(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("compression", "zstd").parquet(path)


def ndjson_gzip(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """NDJSON with null keys kept."""
    df.write.mode(mode).option("compression", "gzip").option("ignoreNullFields", False).json(path)


def csv(df: DataFrame, path: str, columns: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """CSV with a header: the given columns, or all in alphabetical order."""
    df.select(*(columns or sorted(df.columns))).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def jsonl(df: DataFrame, path: str, columns: Sequence[str], mode: str = "errorifexists") -> None:
    df.select(*columns).write.mode(mode).json(path)


def append_log(df: DataFrame, path: str) -> None:
    """Add rows to an append-only NDJSON log; each write is one job, committed whole."""
    df.write.mode("append").json(path)


def lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One text file of sorted lines, for small control files such as checksums."""
    df.coalesce(1).write.mode(mode).text(path)


def report(values: dict, path: str) -> None:
    """A small JSON report, written beside the target and moved over it."""
    partial = path + ".partial"
    with open(partial, "w", encoding="utf-8") as f:
        json.dump(values, f, ensure_ascii=False, indent=2, sort_keys=True)
    os.replace(partial, path)


def promote(tables: dict[str, DataFrame], target: str, replace: bool = False) -> dict[str, str]:
    """Write a set of tables so that all of them appear or none: each is written as ``<name>.partial`` and only then all
    are moved to their places; where a move fails, those made are undone and what stood there is put back. Refuses to
    overwrite unless ``replace`` is set."""
    spark = next(iter(tables.values())).sparkSession
    jvm = spark.sparkContext._jvm
    at = lambda name: jvm.org.apache.hadoop.fs.Path(f"{target}/{name}")
    fs = at("x").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    taken = [n for n in tables if fs.exists(at(n))]
    if taken and not replace:
        raise ValueError(f"already there: {taken}")
    done: list[tuple[str, str]] = []

    def move(a: str, b: str) -> None:
        if not fs.rename(at(a), at(b)):
            raise OSError(f"can't move {a} to {b}")
        done.append((a, b))

    try:
        for name, df in tables.items():
            zstd_parquet(df, f"{target}/{name}.partial", "overwrite")
        for name in taken:
            fs.delete(at(name + ".old"), True)
            move(name, name + ".old")
        for name in tables:
            move(name + ".partial", name)
    except Exception:
        for a, b in reversed(done):
            fs.rename(at(b), at(a))
        for name in tables:
            fs.delete(at(name + ".partial"), True)
        raise
    for name in taken:
        fs.delete(at(name + ".old"), True)
    return {name: f"{target}/{name}" for name in tables}


def link_files(paths: DataFrame, source: str, target: str) -> DataFrame:
    """(path, how): each file linked into ``target``, or copied where a link can't be made; runs on the executors, over a
    folder they share."""
    import shutil
    from collections.abc import Iterator

    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            how = []
            for p in b.path:
                a, z = os.path.join(source, p), os.path.join(target, p)
                os.makedirs(os.path.dirname(z), exist_ok=True)
                if os.path.exists(z):
                    how.append("kept")
                    continue
                try:
                    os.link(a, z)
                    how.append("linked")
                except OSError:
                    shutil.copyfile(a, z)
                    how.append("copied")
            yield pd.DataFrame({"path": b.path, "how": how})

    return paths.select("path").mapInPandas(run, "path string, how string")
