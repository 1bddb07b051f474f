import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftwork.functions import text as X
from siftwork.functions import values as V
from siftwork.functions.keys import hex_key, norm_key, one_row_per


def col(spark, values, shape="c string"):
    return spark.createDataFrame([(v,) for v in values], shape)


def run(spark, values, expr, shape="c string"):
    return [r[0] for r in col(spark, values, shape).repartition(1).select(expr).collect()]


def test_clean_text(spark):
    values = ["&lt;b&gt;x", "a<br>b", " a  b\x1c ", "", "  ", None, "caf&eacute;", "<p></p>"]
    assert run(spark, values, X.clean_text("c")) == ["x", "ab", "a b", None, None, None, "café", None]
    assert run(spark, ["&amp;lt;", "&quot;&#39;"], X.clean_text("c", "basic")) == ["&lt;", "\"'"]


def test_terms_are_whole_words_and_keywords_are_not(spark):
    values = ["a grave here", "engraved", "égrave", "GRAVE", None, "human remains"]
    assert run(spark, values, X.contains_term("c", ["grave", "human remains", " ", "x.y"])) == [True, False, False, True, False, True]
    assert run(spark, ["blueprint", None], X.contains_keyword("c", ["print"])) == [True, False]
    assert run(spark, ["x"], X.contains_term("c", ["", " "])) == [False]


@pytest.mark.parametrize(
    "limit, want",
    [
        (4, ["one…", "abc…", "a,…", "x", "ééé…"]),
        (7, ["one…", "abcdef…", "a…", "x", "éééééé…"]),
        (9, ["one…", "abcdefgh…", "a, b…", "x", "éééééééé…"]),
        (13, ["one two three", "abcdefghij", "a, b; c. d…", "x", "éééééééééééé…"]),
    ],
)
def test_truncate_words(spark, limit, want):
    values = ["one two three", "abcdefghij", "a, b; c. d e f", "x", "é" * 20]
    assert run(spark, values, X.truncate_words("c", limit)) == want


def test_model_text(spark):
    shape = "title string, object_type string, scientific_name string, creator string, date string, place string, topics string, description string"
    rows = [("Bowl", "bowl", None, None, None, None, "Ceramics", "BOWL"), (None,) * 8, (" ;Bowl., ", "Cup", None, "", " ", None, None, "long " * 100), ("t" * 600, None, None, None, None, None, None, None)]
    got = [r[0] for r in spark.createDataFrame(rows, shape).repartition(1).select(X.model_text()).collect()]
    assert got[0] == "Bowl. Topics: Ceramics." and got[1] == ""
    assert got[2].startswith("Bowl. Object type: Cup. Description: long long") and got[2].endswith("….")
    assert len(got[3]) <= 512
    with pytest.raises(ValueError):
        X.model_text(max_chars=0)


def test_urls(spark):
    h = "https://ids.museum.example"
    values = [f"{h}/ids/deliveryService?id=A", f"{h}/ids/deliveryService?id=A&max=9&x=1", f"{h}/ids/deliveryService/id/ark:/1/m2", f"{h}/ids/deliveryService/id/ark:/1/m2/90/", "https://other/ids/deliveryService?id=A", None, "nothing"]
    want = [f"{h}/ids/deliveryService?id=A&max=512", f"{h}/ids/deliveryService?id=A&max=512&x=1", f"{h}/ids/deliveryService/id/ark:/1/m2/512", f"{h}/ids/deliveryService/id/ark:/1/m2/512", values[4], None, "nothing"]
    assert run(spark, values, X.derivative_url("c", "IDS.museum.example")) == want
    assert run(spark, ["HTTP://Host/a", "Host", None], X.media_host("c")) == ["host", "", ""]
    assert run(spark, ["HTTP://Host/a", "Host", None], X.netloc("c")) == ["Host", "", ""]


def test_join_int_presence(spark):
    assert run(spark, [["a", " a ", "b", "", None], [], None], X.join_values("c"), "c array<string>") == ["a; b", None, None]
    assert run(spark, ["7", "1.5", "x", None, ""], X.int_or_null("c")) == [7, None, None, None, None]
    assert run(spark, ["x", "  ", "", None], X.present("c")) == [True, False, False, False]
    assert run(spark, ["x", " ", "", None], X.missing_falsy("c")) == [False, False, True, True]
    assert run(spark, ["x", " ", "", None], X.missing_blank("c")) == [False, True, True, True]


def test_hashes_and_ratios(spark):
    import hashlib

    df = spark.createDataFrame([("a", None)], "a string, b string")
    assert df.select(V.seeded_sha("s", ["a", "b"])).first()[0] == hashlib.sha256(b"s:a|").hexdigest()
    assert df.select(V.seeded_sha("s", ["a", "b"], null_as="None")).first()[0] == hashlib.sha256(b"s:a|None").hexdigest()
    df = spark.createDataFrame([(1, 8, 5), (1, 0, 5), (None, 1, 5)], "a long, b long, c long")
    assert [r[0] for r in df.repartition(1).select(V.ratio("a", "b", 2)).collect()] == [0.12, 0.0, 0.0]
    assert df.select(V.file_name("c")).first()[0] == "00000005.jpg"


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>").repartition(1)
    assert [r[0] for r in df.select(V.l2_normalize("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]
    assert df.select(V.dot("v", "v")).first()[0] == 25.0 and math.isclose(df.select(V.norm("v")).first()[0], 5.0)


def test_bits(spark):
    assert run(spark, ["ffffffffffffffff", " 0000000000000001", "zz", None, ""], V.hex_bits("c")) == [-1, 1, None, None, None]
    assert spark.range(1).select(V.hamming(F.lit(-1).cast("bigint"), F.lit(0).cast("bigint"))).first()[0] == 64


def test_perceptual_hash():
    r = np.random.default_rng(2)
    img = np.kron(r.integers(0, 255, (8, 8)), np.ones((16, 16)))
    h = int(V.perceptual_hash(img), 16)
    assert len(V.perceptual_hash(img)) == 16
    assert bin(h ^ int(V.perceptual_hash(img * 0.9 + 10), 16)).count("1") <= 4
    assert bin(h ^ int(V.perceptual_hash(np.kron(img, np.ones((2, 3)))), 16)).count("1") <= 4
    with pytest.raises(ValueError):
        V.perceptual_hash(img, 1)


def test_scaling_keeps_flat_pictures_and_means():
    for n in (5, 32, 100, 257):
        w = V._weights(32, n)
        assert np.allclose(w.sum(axis=1), 1) and np.allclose(w @ np.full(n, 7.0), 7)
    assert np.allclose(V._weights(32, 32), np.eye(32))
    ramp = V._weights(32, 128) @ np.arange(128.0)
    assert np.allclose(np.diff(ramp)[4:-4], 4, atol=0.05)


def test_keys(spark):
    assert run(spark, [" Ab ", "", "  ", None], norm_key("c")) == ["ab", None, None, None]
    assert run(spark, ["AB", "abc", "x1"], hex_key("c", 2)) == ["ab", None, None]
    df = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z"), (2, None)], "k long, v string")
    assert sorted(tuple(r) for r in one_row_per(df, "k", ["v"]).collect()) == [(1, "a"), (2, None)]
