"""Sources: index files, NDJSON shards, logs, reports, images, archives and checksum files."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def unit_index(spark: SparkSession, path: str) -> DataFrame:
    """(unit, url) of a top index: the unit is the name of the file's folder in upper case; the last line of a unit wins."""
    lines = spark.read.text(path).select(F.trim("value").alias("url"), F.monotonically_increasing_id().alias("n")).where("url <> ''")
    unit = F.upper(F.try_element_at(F.split("url", "/"), F.lit(-2)))
    return lines.select(unit.alias("unit"), "url", "n").where("unit IS NOT NULL").groupBy("unit").agg(F.max_by("url", "n").alias("url"))


def shard_urls(spark: SparkSession, path: str) -> DataFrame:
    """(url) of a unit index: trimmed lines that aren't blank."""
    return spark.read.text(path).select(F.trim("value").alias("url")).where("url <> ''")


def ndjson(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str, strict: bool = True) -> DataFrame:
    """Records of NDJSON shards, gzip included, with a given schema so that nothing is read twice. ``strict`` raises at the
    first broken line; otherwise broken lines and those that are no object are skipped, and a value that doesn't fit its
    column is null. Blank lines are skipped."""
    if strict:
        return spark.read.schema(schema).json(path if isinstance(path, str) else list(path), mode="FAILFAST")
    return ndjson_text(spark, path).select(F.from_json("record_json", schema).alias("r")).select("r.*")


def ndjson_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(record_json, path) of NDJSON shards kept as text, for records of any shape; lines that are no JSON object are
    skipped."""
    lines = spark.read.text(path if isinstance(path, str) else list(path)).select(F.col("value").alias("record_json"), F.col("_metadata.file_path").alias("path"))
    return lines.where(F.ltrim("record_json").startswith("{") & F.try_parse_json("record_json").isNotNull())


def parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def parquet_schema(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(column, type), from the footers alone."""
    return spark.read.parquet(path).dtypes


def log_latest(spark: SparkSession, path: str, schema: T.StructType | str, key: str, order: Sequence[str]) -> DataFrame:
    """The latest row of each key of an append-only NDJSON log; a broken line is an error."""
    from siftwork.operators.release import latest

    return latest(ndjson(spark, path, schema, strict=True), key, order)


def exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def report(spark: SparkSession, path: str) -> DataFrame:
    """A JSON report of several lines; a missing file gives an empty table, any other fault is an error."""
    if not exists(spark, path):
        return spark.createDataFrame([], T.StructType())
    return spark.read.option("multiLine", True).json(path)


def config(spark: SparkSession, path: str) -> dict:
    """A small configuration file as a dictionary: JSON, or YAML where its parser is installed."""
    import json

    text = "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())  # one small file
    if not path.rstrip("/").endswith((".yaml", ".yml")):
        return json.loads(text)
    try:
        import yaml
    except ImportError as e:
        raise ValueError("YAML needs a parser that isn't installed") from e
    return yaml.safe_load(text)


def line_counts(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """(lines): lines of text files that aren't blank, a header of each file not counted."""
    per = spark.read.text(path).where(F.trim("value") != "").groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return per.agg(F.coalesce(F.sum(F.col("n") - int(header)), F.lit(0)).alias("lines"))


def binary_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, content) with paths relative to ``path``; columns that aren't used aren't read."""
    root = path.rstrip("/")
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    return df.select(F.regexp_replace("path", r"^.*?" + _quote(root.removeprefix("file://")) + "/", "").alias("path"), "length", "content")


def _quote(s: str) -> str:
    return r"\Q" + s.replace(r"\E", r"\E\\E\Q") + r"\E"


def images(spark: SparkSession, path: str) -> DataFrame:
    """(path, width, height, channels, data) decoded in the JVM; files that don't decode are left out."""
    df = spark.read.format("image").option("dropInvalid", True).load(path)
    return df.select(F.col("image.origin").alias("path"), F.col("image.width").alias("width"), F.col("image.height").alias("height"), F.col("image.nChannels").alias("channels"), F.col("image.data").alias("data"))


def zip_members(files: DataFrame, suffix: str = "") -> DataFrame:
    """(path, member, content) of the members of zip archives in a ``binaryFile`` table whose names end in ``suffix``."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for path, content in zip(b.path, b.content):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for name in z.namelist():  # a member at a time, so that an archive needn't fit unpacked
                        if name.endswith(suffix) and not name.endswith("/"):
                            yield pd.DataFrame({"path": [path], "member": [name], "content": [z.read(name)]})

    return files.select("path", "content").mapInPandas(read, "path string, member string, content binary")


def checksum_file(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value")
