import io
import json
import os
import struct
import zipfile
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.functions.values import grey_phash
from siftwork.operators import images, release
from siftwork.session import cut, drop_cut, fits_broadcast
from siftwork.sources import readers, writers


def png(width, height):
    px = np.random.default_rng(width).integers(0, 255, (height, width, 3), dtype=np.uint8)
    raw = b"".join(b"\0" + row.tobytes() for row in px)
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def test_index_and_shards(spark, tmp_path):
    (tmp_path / "index.txt").write_text("http://h/data/abc/index.txt\n\nhttp://h/data/def/index.txt\nhttp://h/new/abc/index.txt\n")
    assert {r.unit: r.url for r in readers.unit_index(spark, str(tmp_path / "index.txt")).collect()} == {"ABC": "http://h/new/abc/index.txt", "DEF": "http://h/data/def/index.txt"}
    assert readers.shard_urls(spark, str(tmp_path / "index.txt")).count() == 3


def test_ndjson_strict_and_lenient(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"x": 1}\n\n{"x": \n[1]\n{"x": 3}\n')
    assert sorted(r.x for r in readers.ndjson(spark, str(tmp_path), "x long", strict=False).collect()) == [1, 3]
    with pytest.raises(Exception):
        readers.ndjson(spark, str(tmp_path), "x long").collect()
    assert readers.ndjson_text(spark, str(tmp_path)).count() == 2


def test_routed_tables_have_the_schema(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "x long, s string")
    where = writers.routed(df, str(tmp_path / "r"), "s", ("a", "b"))
    assert spark.read.parquet(where["b"]).dtypes == df.dtypes and spark.read.parquet(where["b"]).count() == 0
    assert spark.read.parquet(where["all"]).count() == 2
    with pytest.raises(Exception):
        writers.routed(df, str(tmp_path / "r"), "s", ("a",))


def test_null_keys_survive_and_logs_append(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "id long, s string")
    writers.ndjson_gzip(df, str(tmp_path / "n"))
    assert spark.read.text(str(tmp_path / "n")).first().value == '{"id":1,"s":null}'
    for seq in (1, 2):
        writers.append_log(df.withColumn("seq", F.lit(seq)), str(tmp_path / "log"))
    assert [r.seq for r in readers.log_latest(spark, str(tmp_path / "log"), "id long, seq long", "id", ["seq"]).collect()] == [2]


def test_csv_quotes(spark, tmp_path):
    df = spark.createDataFrame([('a "b", c', 'x'), (None, "y")], "b string, a string")
    writers.csv(df, str(tmp_path / "c"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    assert back.columns == ["a", "b"] and {tuple(r) for r in back.collect()} == {("x", 'a "b", c'), ("y", None)}


def test_files_checksums_links_and_zip(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    (tmp_path / "in/a.txt").write_bytes(b"abc")
    (tmp_path / "in/sub/b.txt").write_bytes(b"d")
    files = readers.binary_files(spark, str(tmp_path / "in"), "*.txt")
    sums = release.file_checksums(files)
    assert {r.path for r in sums.collect()} == {"a.txt", "sub/b.txt"}
    assert {r.verdict for r in release.verify_checksums(release.checksum_lines(sums), sums).collect()} == {"ok"}
    expected = spark.createDataFrame([("a.txt",), ("gone",)], "path string")
    assert {r.path: r.present for r in release.artifact_manifest(expected, files).collect()} == {"a.txt": True, "gone": False}
    assert {r.how for r in writers.link_files(files, str(tmp_path / "in"), str(tmp_path / "out")).collect()} == {"linked"}
    assert (tmp_path / "out/sub/b.txt").read_bytes() == b"d"
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("m/x.csv", "1")
        z.writestr("y.txt", "2")
    got = readers.zip_members(readers.binary_files(spark, str(tmp_path), "*.zip"), ".csv").collect()
    assert [(r.member, bytes(r.content)) for r in got] == [("m/x.csv", b"1")]
    writers.lines(release.checksum_lines(sums), str(tmp_path / "sums"))
    assert readers.checksum_file(spark, str(tmp_path / "sums")).count() == 2
    writers.report({"b": 1}, str(tmp_path / "r.json"))
    assert json.loads((tmp_path / "r.json").read_text()) == {"b": 1} and not os.path.exists(tmp_path / "r.json.partial")
    assert readers.report(spark, str(tmp_path / "r.json")).first().b == 1 and readers.report(spark, str(tmp_path / "none.json")).count() == 0


def test_images(spark, tmp_path):
    (tmp_path / "i").mkdir()
    (tmp_path / "i/a.png").write_bytes(png(300, 200))
    (tmp_path / "i/b.png").write_bytes(png(90, 10))
    (tmp_path / "i/c.png").write_bytes(b"broken")
    df = readers.images(spark, str(tmp_path / "i")).withColumn("q", images.image_checks()).withColumn("h", grey_phash("data", "width", "height", "channels")).withColumn("s", images.grey_deviation("data", "width", "height", "channels"))
    got = {r.width: r for r in df.collect()}
    assert set(got) == {300, 90} and got[300].q.errors == [] and got[90].q.errors == ["TOO_SMALL"] and got[90].q.flags == ["EXTREME_ASPECT"]
    assert len(got[300].h) == 16 and got[300].s > 2


def test_fetch_outcomes(spark):
    def get(url):
        if url == "busy":
            return images.Answer(503)
        if url == "io":
            raise OSError("x" * 500)
        if url == "bug":
            raise KeyError("k")
        return {"ok": images.Answer(200, "image/png", b"abc"), "html": images.Answer(200, "text/html"), "big": images.Answer(200, "image/png", b"x" * 99), "gone": images.Answer(404)}[url]

    names = ["ok", "html", "big", "gone", "busy", "io", "bug", "", None]
    df = spark.createDataFrame([(i, n, f"o{i}", None if i else 7) for i, n in enumerate(names)], "image_id long, image_url string, url string, n long")
    got = {r.image_id: r for r in images.fetch(df, get, attempts=2, backoff=0, most_bytes=50, keep=["url", "n"]).collect()}
    assert [i for i in got if got[i].retryable] == [4, 5] and got[0].mime == "image/png" and all(r.seconds >= 0 for r in got.values())
    assert [got[i].url for i in range(9)] == [f"o{i}" for i in range(9)] and (got[0].n, got[1].n) == (7, None)
    assert [got[i].error and got[i].error[:20] for i in range(9)] == [None, "UNEXPECTED_MIME:text", "TOO_LARGE", "HTTP_404", "HTTP_503", "OSError: " + "x" * 11, "KeyError: 'k'", "MISSING_IMAGE_URL", "MISSING_IMAGE_URL"]
    assert [got[i].attempts for i in range(9)] == [1, 1, 1, 1, 2, 2, 1, 0, 0] and len(got[5].error) == 200


def test_embed(spark):
    df = spark.createDataFrame([(i, bytes([i + 1, 2])) for i in range(5)], "image_id long, content binary")
    out = images.embed(df, lambda items: np.array([[b[0], b[1]] for b in items], dtype=float), batch=2).collect()
    assert len(out) == 5 and all(abs(sum(x * x for x in r.embedding) - 1) < 1e-5 for r in out)


def test_normalize_needs_pillow_or_works():
    data = png(600, 300)
    try:
        import PIL  # noqa: F401
    except ImportError:
        with pytest.raises(ImportError):
            images.normalize_jpeg(data)
        return
    out = images.normalize_jpeg(data)
    assert (out["width"], out["height"]) == (512, 256) and len(out["sha256"]) == 64 and io.BytesIO(out["data"])


def test_cut_and_broadcast_bound(spark):
    df = spark.range(100)
    kept = cut(df, "t")
    assert kept.count() == 100 and kept.dtypes == df.dtypes
    drop_cut(kept)
    assert fits_broadcast(df, 8) and not fits_broadcast(df, 8, rows=99) and not fits_broadcast(df, 10, size=999)
