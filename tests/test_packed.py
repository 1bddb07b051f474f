"""Packed fields against a second, plain reading of the rules."""

import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from siftwork.operators import packed

CLOSE = {'"': '"', "“": "”"}
MARKS = set(";；|•·\t\n")


def plain_terms(s, comma_field):
    s = s.strip(" ")
    if len(s) > 1 and s[0] == "[" and s[-1] == "]":
        s = s[1:-1].strip(" ")
    literal = set()
    for m in re.finditer(r"&(#\d+|#x[0-9a-fA-F]+|amp|quot|lt|gt|eacute);", s):
        literal |= set(range(m.start(), m.end()))

    def is_sep(i, commas):
        if i in literal or i >= len(s):
            return False
        c = s[i]
        if c in MARKS or commas and c == ",":
            return True
        return c == "/" and (i == 0 or s[i - 1] == " ") and (i + 1 == len(s) or s[i + 1] == " ")

    def walk(commas):
        terms, hard, i = [], 0, 0
        while i <= len(s):
            while i < len(s) and s[i] == " ":
                i += 1
            start, quoted = i, False
            if i < len(s) and s[i] in CLOSE:
                j = i + 1
                while j < len(s):
                    if s[j] == "\\":
                        j += 2
                        continue
                    if s[j] == CLOSE[s[i]]:
                        if s[i] == '"' and s[j + 1 : j + 2] == '"':
                            j += 2
                            continue
                        k = j + 1
                        while k < len(s) and s[k] == " ":
                            k += 1
                        if k == len(s) or is_sep(k, True):
                            quoted = True
                            break
                    j += 1
                if quoted:
                    i = j + 1
                    while i < len(s) and not is_sep(i, commas):
                        i += 1
            if not quoted:
                while i < len(s) and not is_sep(i, commas):
                    i += 1
            raw = s[start:i].strip(" ")
            if i < len(s) and s[i] != ",":
                hard += 1
            terms.append((raw, quoted and raw[-1:] == CLOSE[raw[0]]))
            i += 1
        return terms, hard

    both, hard = walk(True)
    if hard:
        terms = walk(False)[0]
    elif comma_field or all(q for t, q in both if t):
        terms = both
    else:
        terms = [(s, len(both) == 1 and both[0][1])]
    out = []
    for t, q in terms:
        if q:
            t = re.sub(r"\\(.)", r"\1", t[1:-1] if t[0] == '"' else t[1:-1])
            t = t.replace('""', '"')
        t = html.unescape(t).strip()
        if t:
            out.append(t)
    return out


@pytest.mark.parametrize(
    "text, comma, want",
    [
        ("Glass; Moths", False, ["Glass", "Moths"]),
        ('["Law, maritime", "Moths"]', True, ["Law, maritime", "Moths"]),
        ('"Quia ""Fixze"" S", "A, B"', False, ['Quia "Fixze" S', "A, B"]),
        ("Smith, Jane, 1800-1850", False, ["Smith, Jane, 1800-1850"]),
        ("Arts &amp; crafts, Bells", True, ["Arts & crafts", "Bells"]),
        ("Black/white; a / b", True, ["Black/white", "a", "b"]),
        ('"Printing; drafts",Costume', True, ["Printing; drafts", "Costume"]),
        ('Jo "Nick" Doe | “X, Y”', False, ['Jo "Nick" Doe', "X, Y"]),
        ('["G \\"N\\" T", "S, H"]', False, ['G "N" T', "S, H"]),
        (";Markets;;  ; Markets;", True, ["Markets", "Markets"]),
        ("a b c", True, ["a", "b", "c"]),
        ("", True, []),
        ("   ", True, []),
        ("[]", True, []),
        ('"', True, ['"']),
        ("Masks, Owls;", True, ["Masks, Owls"]),
    ],
)
def test_rules(text, comma, want):
    assert packed.parse(text, comma)[0] == want


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet='ab ,;|/"“”&\\[]\t', max_size=24), st.booleans())
def test_any_text_is_read(text, comma):
    terms, _ = packed.parse(text, comma)
    assert all(t and t == t.strip() for t in terms)
    packed.parse(text * 50, comma)


def test_whole_table_against_plain_reading(spark, small):
    rows = spark.read.parquet(f"{small}/metadata.parquet").select("image_id", *packed.FIELDS).distinct()
    got = {}
    for r in packed.split_packed(rows, min_terms=2).collect():
        got.setdefault((r.image_id, r.field_name), {})[r.pos] = r.item_value
    want = {}
    for r in rows.collect():
        for f in packed.FIELDS:
            if r[f] and len(t := plain_terms(r[f], f in packed.COMMA_FIELDS)) > 1:
                want[r.image_id, f] = dict(enumerate(t, 1))
    assert got == want


def test_known_values_keep_their_comma(spark):
    rows = [(i, None, t, None, None) for i, t in enumerate(['"Law, maritime"; Moths', '"Law, maritime"; Owls', "Moths; Owls", "Moths | Owls", "Law, maritime, Moths", "Moths, Owls, Law, maritime", "Moths, Owls"])]
    df = spark.createDataFrame(rows, "image_id long, related_names string, topics string, place string, object_type string")
    got = {}
    for r in packed.split_packed(df, min_terms=2).collect():
        got.setdefault(r.image_id, {})[r.pos] = r.item_value
    assert list(got[4].values()) == ["Law, maritime", "Moths"]
    assert sorted(got[5].items()) == [(1, "Moths"), (2, "Owls"), (3, "Law, maritime")]
    assert list(got[6].values()) == ["Moths", "Owls"]


def test_fields_of_one_term_tell_terms_of_their_own(spark):
    """"Owls, Moths" is seen twice in quotes, but both parts are known from fields that hold nothing else, so it is a list."""
    rows = [(i, None, t, None, None) for i, t in enumerate(['"Owls, Moths"; Bells', '"Owls, Moths"; Bells', "Owls", "Owls", "Moths", "Moths", "Owls, Moths, Glass"])]
    df = spark.createDataFrame(rows, "image_id long, related_names string, topics string, place string, object_type string")
    for n in (1, 2):
        got = {r.pos: r.item_value for r in packed.split_packed(df, min_terms=n).where("image_id = 6").collect()}
        assert got == {1: "Owls", 2: "Moths", 3: "Glass"}


def test_blocks_of_the_dictionary_give_the_same(spark, monkeypatch, tiny):
    df = spark.read.parquet(f"{tiny}/metadata.parquet")
    want = sorted(packed.split_packed(df, min_support=1).collect())
    monkeypatch.setattr(packed, "BLOCK_BYTES", 100)
    monkeypatch.setattr(packed, "SHARD_VALUES", 7)
    assert sorted(packed.split_packed(df, min_support=1).collect()) == want


@pytest.mark.parametrize("size", [8 << 20, 40, 1])
def test_known_values_in_brackets_and_entities(spark, monkeypatch, size):
    monkeypatch.setattr(packed, "BLOCK_BYTES", size)
    monkeypatch.setattr(packed, "SHARD_VALUES", 2)
    known = ["Lindt, Vera", "Salt & Pepper, Inc.", "Ulm, Neu-, Alt"]
    rows = [(i, None, f"{v}; clay {i}", None, None) for i, v in enumerate(known * 2)]
    fields = ["[Lindt, Vera, glass]", " [ wax , Lindt, Vera ] ", "Salt &amp; Pepper, Inc., tin", "tin, Ulm, Neu-, Alt, Lindt, Vera", "[Lindt, Vera]", "Lindt, Vera, Lindt, Vera", "[a, b", "Vera, Lindt"]
    rows += [(100 + i, None, f, None, None) for i, f in enumerate(fields)] + [(200 + i, None, fields[0], None, None) for i in range(5)]
    out = {}
    for r in packed.split_packed(spark.createDataFrame(rows, "image_id long, related_names string, topics string, place string, object_type string")).collect():
        out.setdefault(r.image_id, {})[r.pos] = r.item_value
    got = [list(dict(sorted(out[100 + i].items())).values()) for i in range(len(fields))]
    assert got == [["Lindt, Vera", "glass"], ["wax", "Lindt, Vera"], ["Salt & Pepper, Inc.", "tin"], ["tin", "Ulm, Neu-, Alt", "Lindt, Vera"], ["Lindt, Vera"], ["Lindt, Vera", "Lindt, Vera"], ["[a", "b"], ["Vera", "Lindt"]]
    assert all(out[200 + i] == out[100] for i in range(5))


def test_nulls_copies_empty_and_extra_columns(spark):
    shape = "image_id long, related_names string, topics string, place string, object_type string, terms string, pos int, value string"
    assert packed.split_packed(spark.createDataFrame([], shape)).count() == 0
    rows = [(1, None, "a;b", "", "x" * 300_000 + ";y", "t", 3, "v"), (1, None, "a;b", "", "x" * 300_000 + ";y", "u", 4, "w"), (None, "a;b", "a;b", "a", "b", "", 0, "")]
    out = packed.split_packed(spark.createDataFrame(rows, shape)).collect()
    assert sorted((r.field_name, r.pos, len(r.item_value)) for r in out) == [("object_type", 1, 300_000), ("object_type", 2, 1), ("topics", 1, 1), ("topics", 2, 1)]
