import json

from siftwork.operators import flatten, nested

RECORD = {
    "id": "rec:77", "unitCode": "U", "title": "T", "type": "catalogue", "hash": "h", "timestamp": 5, "lastTimeUpdated": "6",
    "content": {
        "freetext": {"name": [{"label": "Sitter", "content": "A <b>B</b>"}, None, {"label": "Maker", "content": "C &amp; D"}], "notes": {"label": "Summary", "content": "S"}, "date": []},
        "indexedStructured": {"topic": ["x", None, 3], "place": "P", "geo": [{"L1": {"content": "c"}}]},
        "descriptiveNonRepeating": json.dumps({
            "record_ID": "o1", "metadata_usage": {"access": "CC0"}, "title": {"content": "Title"}, "data_source": "Inst",
            "online_media": {"media": [
                {"id": "m1", "type": "Images", "usage": {"access": "CC0"}, "content": "https://ids.museum.example/ids/deliveryService?id=X1", "resources": [{"label": "Screen Image", "url": "u1"}, None, {"label": "High-resolution JPEG", "url": "u2", "width": "10", "height": 20}]},
                None,
                {"id": "m2", "type": "Images", "usage": {"access": "restricted"}, "resources": {"label": "one"}},
            ]},
        }),
    },
}


def rows(spark, *texts):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "line_id long, record_json string, item_path string, ordinal int")


def paths(df):
    return sorted((r.line_id, r.item_path) for r in df.collect())


WANT = ["freetext.name[0]", "freetext.name[2]", "freetext.notes[0]", "indexedStructured.geo[0]", "indexedStructured.place[0]", "indexedStructured.topic[0]", "indexedStructured.topic[2]", "online_media.media[0]", "online_media.media[0].resources[0]", "online_media.media[0].resources[2]", "online_media.media[2]", "online_media.media[2].resources[0]"]


def test_paths(spark):
    plain, wrapped = json.dumps(RECORD), json.dumps({"record": RECORD})
    got = paths(nested.explode_levels(rows(spark, plain, wrapped, plain[:-5], None, "", "[1]", "NaN", '{"content": null}', '{"content": {"freetext": {"n": NaN}}}', "[" * 5000)))
    assert got == [(i, p) for i in (0, 1) for p in WANT]


def test_lone_surrogates_and_odd_keys(spark):
    text = '{"content": {"freetext": {"a.b": [{"label": "\\ud800", "content": "\\ud800x"}]}, "indexedStructured": {"": ["\\udfff"]}}}'
    assert [p for _, p in paths(nested.explode_levels(rows(spark, text)))] == ["freetext.a.b[0]", "indexedStructured.[0]"]


def test_empty_table_and_copies(spark):
    assert nested.explode_levels(rows(spark, "x").where("false")).count() == 0
    twice = rows(spark, json.dumps(RECORD)).union(rows(spark, json.dumps(RECORD)))
    assert len(paths(nested.explode_levels(twice))) == len(WANT)


def test_flat_tables_keep_their_parents(spark):
    t = nested.flat_tables(rows(spark, json.dumps(RECORD)))
    keys = {r.key for r in t["media"].collect()}
    assert {r.parent_key for r in t["resources"].collect()} <= keys
    assert {r.parent_key for r in t["media"].collect()} == {r.key for r in t["records"].collect()} == {"0"}
    res = {r.item_path: (r.width, r.height) for r in t["resources"].collect()}
    assert res["online_media.media[0].resources[2]"] == (10, 20)
    assert sorted((r.group, r.content) for r in t["indexed_terms"].collect() if r.group == "topic") == [("topic", "3"), ("topic", "x")]


def test_merged_schema(spark):
    got = {(r.path, r.kind): r.n for r in nested.infer_schema(rows(spark, json.dumps(RECORD), "{broken", None)).collect()}
    assert got["$.content.freetext.name[]", "object"] == 2 and got["$.content.freetext.name[]", "null"] == 1
    assert got["$.content.descriptiveNonRepeating.online_media.media[].resources", "object"] == 1
    assert got["!broken", "string"] == 1


def test_candidates(spark):
    out = flatten.candidates(rows(spark, json.dumps(RECORD)), host="ids.museum.example").collect()
    assert len(out) == 1
    r = out[0]
    assert (r.object_id, r.media_id, r.related_names, r.creator, r.description, r.place, r.topics) == ("o1", "m1", "A B; C & D", "C & D", "S", "P", "x; 3")
    assert (r.source_width, r.source_height, r.screen_url, r.highres_jpeg_url) == (10, 20, "u1", "u2")
    assert r.image_url == "https://ids.museum.example/ids/deliveryService?id=X1&max=512"
    assert flatten.candidates(rows(spark, json.dumps(RECORD)), open_only=False).count() == 2


def test_name_under_another_label_is_no_creator_and_closed_records_give_nothing(spark):
    x = json.loads(json.dumps(RECORD))
    x["content"]["freetext"]["name"] = [{"label": "Sitter", "content": "Q"}]
    y = json.loads(json.dumps(RECORD))
    y["content"]["descriptiveNonRepeating"] = json.loads(y["content"]["descriptiveNonRepeating"]) | {"metadata_usage": {"access": "x"}}
    out = flatten.candidates(rows(spark, json.dumps(x), json.dumps(y))).collect()
    assert [(r.creator, r.related_names) for r in out] == [(None, "Q")]


def test_tables_and_columns_follow_the_schema(spark):
    x = json.loads(json.dumps(RECORD)) | {"url": "u", "extra": {"tags": ["p", {"q": 1, "deep": [[5, None], 6]}], "n": 2}}
    x["content"]["indexedStructured"]["geo"] = {"L1": {"content": "c", "type": "t"}, "alt": [{"z": "w"}]}
    x["content"]["descriptiveNonRepeating"] = json.dumps(json.loads(x["content"]["descriptiveNonRepeating"]) | {"guid": "g", "unit_code": "U"})
    t = nested.flat_tables(rows(spark, json.dumps(x), "{broken", "[1]"))
    (r,) = t["records"].collect()
    assert (r.object_id, r.unit_code, r.url, r.timestamp, r.lastTimeUpdated, r.extra_n) == ("o1", "U", "u", "5", "6", "2")
    assert (r.content_descriptiveNonRepeating_guid, r.content_descriptiveNonRepeating_unit_code, r.content_descriptiveNonRepeating_title_content) == ("g", "U", "Title")
    left = json.loads(r.value)
    assert left["url"] == "u" and left["extra"] == {"n": 2} and left["content"]["freetext"] == {}
    (geo,) = t["indexed_terms"].where("group = 'geo'").collect()
    assert (geo.content, geo.L1_content, geo.L1_type, json.loads(geo.value)) == (None, "c", "t", {"L1": {"content": "c", "type": "t"}})
    (alt,) = t["indexed_terms.alt"].collect()
    assert (alt.item_path, alt.parent_key, alt.z) == ("indexedStructured.geo[0].alt[0]", geo.key, "w")
    assert [(v.item_path, v.content, v.q) for v in t["extra.tags"].orderBy("ordinal").collect()] == [("extra.tags[0]", "p", None), ("extra.tags[1]", None, "1")]
    assert {(v.item_path, v.parent_key, v.content) for v in t["extra.tags.deep[]"].collect()} == {("extra.tags[1].deep[0][0]", "0:extra.tags[1].deep[0]", "5"), ("extra.tags[1].deep[1][0]", "0:extra.tags[1].deep[1]", "6")}
    assert t["records"].columns[:10] == ["line_id", "key", "record_id", "unit_code", "title", "type", "hash", "object_id", "data_source", "metadata_access"]
