"""Several values packed in one field: one value per row, position kept.

Method: dictionary-guided segmentation. Known whole values that contain a comma are gathered from the rows in which
they stand unambiguously (quoted, or between marks that can only separate). A multi-pattern automaton over them finds
their occurrences in a field, and dynamic programming picks the cheapest cover of the field by known values and by
the stretches between separators, so a comma inside a legitimate value is protected.
"""

from __future__ import annotations

import html
import re
from collections.abc import Callable, Iterator
from html.entities import html5

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.functions.keys import one_row_per
from siftwork.session import cut, join_hot

# Marks that always separate. White space other than the plain blank separates too; a slash does only
# between blanks; a comma only as described at :func:`parse`.
MARKS = ";；|｜¦‖│┃•·‧∙⋅・･●◦▪◆■▸►※¶؛、"
COMMAS = ",，،"
QUOTES = {'"': '"', "“": "”", "„": "“”", "‟": "”", "‘": "’", "«": "»"}

FIELDS = ("related_names", "topics", "place", "object_type")
COMMA_FIELDS = ("topics", "object_type")

ENTITY = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});"
_HARD = re.compile(rf"({ENTITY})|([{re.escape(MARKS)}]|[^\S ]|(?:(?<=[ ])|(?<![\s\S]))/(?=[ ]|\Z))")
_COMMA = re.compile(f"[{COMMAS}]")
_STOP = rf"[{re.escape(MARKS)}{COMMAS}]|[^\S ]|/(?: |\Z)"
_AFTER_QUOTE = re.compile(rf" *(?:\Z|{_STOP})")
_ESCAPE = re.compile(r"\\(u[0-9a-fA-F]{4}|.)", re.S)
_PLAIN = re.compile(rf"[{re.escape(MARKS)}{COMMAS}/\"“„‟‘«&\[]|[^\S ]")
#: The same as a filter in the JVM: a field without any of these has one term.
MAYBE_PACKED = r"[" + MARKS.replace("|", r"\|") + COMMAS + r"/]|[^\S ]|[\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]"

#: A dictionary above this many bytes is dealt to several automata of about that size.
BLOCK_BYTES = 8 << 20
#: Field values that one task takes to an automaton.
SHARD_VALUES = 200_000


def _entity(text: str) -> bool:
    return text[1] == "#" or text[1:] in html5


def _quoted_end(s: str, at: int) -> int:
    """End of the quoted term that opens at ``at``, or -1 if nothing there is one quoted term."""
    close, i, n = QUOTES[s[at]], at + 1, len(s)
    while i < n:
        c = s[i]
        if c == "\\":
            i += 2
            continue
        if c in close:
            if s[at] == '"' and i + 1 < n and s[i + 1] == '"':
                i += 2
                continue
            if _AFTER_QUOTE.match(s, i + 1):
                return i + 1
        i += 1
    return -1


def _quoted_spans(s: str, separators: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Quoted terms that open right after the start or one of ``separators``."""
    spans, inside = [], 0
    for start in [0, *(b for _, b in separators)]:
        if start < inside:
            continue
        while start < len(s) and s[start] == " ":
            start += 1
        if start < len(s) and s[start] in QUOTES and (end := _quoted_end(s, start)) > 0:
            spans.append((start, end))
            inside = end
    return spans


def _outside(marks: list[tuple[int, int]], spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    if not spans:
        return marks
    return [m for m in marks if not any(a <= m[0] < b for a, b in spans)]


def _clean(raw: str) -> str:
    """A term without surrounding blanks and quotation marks, escapes and doubled quotes undone, entities decoded."""
    t = raw.strip()
    if len(t) > 1 and t[0] in QUOTES and _quoted_end(t, 0) == len(t):
        quote, t = t[0], t[1:-1]
        if "\\" in t:
            t = _ESCAPE.sub(lambda m: chr(int(m[1][1:], 16)) if len(m[1]) == 5 else m[1], t).encode("utf-8", "replace").decode()
        if quote == '"':
            t = t.replace('""', '"')
    return (html.unescape(t) if "&" in t else t).strip()


def body(s: str) -> str:
    """A field without surrounding blanks, and without square brackets around the whole of it: the text that terms are
    cut from and that places of known values refer to."""
    s = s.strip(" ")
    return s[1:-1].strip(" ") if len(s) > 1 and s[0] == "[" and s[-1] == "]" else s


def _body(c: Column) -> Column:
    """:func:`body` in the JVM."""
    c = F.trim(c)
    return F.when(F.length(c) > 1, F.trim(F.regexp_replace(c, r"(?s)\A\[(.*)\]\z", "$1"))).otherwise(c)


def parse(s: str, comma_field: bool, protect: Callable[[str], list[tuple[int, int, float]]] | None = None) -> tuple[list[str], bool]:
    """The non-empty terms of one field, and whether their ends are beyond doubt.

    Marks, white space other than the blank, and a slash between blanks separate. If none of them stands outside
    quotation marks, commas separate: where ``comma_field`` holds, or where every term is quoted. What stands between
    quotation marks that open at the start of a term is one term. Square brackets around the whole field belong to no
    term. An entity's semicolon, hyphens and ampersands never separate. ``protect`` gives stretches of the text that
    are known whole values, with their weight.
    """
    s = s.strip(" ")
    if not _PLAIN.search(s):
        return ([s] if s else []), True
    s = body(s)
    hard = [m.span(2) if m[2] else (m.end() - 1, m.end()) for m in _HARD.finditer(s) if m[2] or not _entity(m[1])]
    commas = [m.span() for m in _COMMA.finditer(s)]
    if not hard and not commas:
        return ([t] if (t := _clean(s)) else []), True
    spans = _quoted_spans(s, sorted(hard + commas))
    seps = _outside(hard, spans)
    soft: list[tuple[int, int]] = []
    if seps:
        spans = _quoted_spans(s, hard)
        seps = _outside(hard, spans)
    elif commas:
        soft = _outside(commas, spans)
        if soft and not comma_field:
            edges = [0, *(x for m in soft for x in m), len(s)]
            parts = [(edges[i], edges[i + 1]) for i in range(0, len(edges), 2)]
            if not all((p := s[a:b].strip(" ")) == "" or any(a <= x and y <= b and s[x:y] == p for x, y in spans) for a, b in parts):
                soft = []
    if soft:
        seps = _cover(s, soft, protect) if protect else soft
    terms, at = [], 0
    for a, b in [*seps, (len(s), len(s))]:
        if t := _clean(s[at:a]):
            terms.append(t)
        at = b
    return terms, not soft or bool(spans)


def _cover(s: str, soft: list[tuple[int, int]], protect: Callable[[str], list[tuple[int, int, float]]]) -> list[tuple[int, int]]:
    """The separators of the cheapest cover. Stretch i runs from separator i-1 to separator i; each stretch costs 1, a
    known whole value over several stretches costs 1 less its weight in all."""
    starts = {}
    ends = {}
    for i, (a, b) in enumerate([*soft, (len(s), len(s))]):
        left = soft[i - 1][1] if i else 0
        starts[left + len(s[left:a]) - len(s[left:a].lstrip(" "))] = i
        ends[left + len(s[left:a].rstrip(" "))] = i
    known: dict[int, list[tuple[int, float]]] = {}
    for a, b, w in protect(s):
        if a in starts and b in ends and ends[b] > starts[a]:
            known.setdefault(ends[b], []).append((starts[a], 1 - w))
    if not known:
        return soft
    n = len(soft) + 1
    cost, back = [0.0] + [0.0] * n, [0] * (n + 1)
    for i in range(1, n + 1):
        cost[i], back[i] = cost[i - 1] + 1, i - 1
        for j, c in known.get(i - 1, ()):
            if cost[j] + c < cost[i]:
                cost[i], back[i] = cost[j] + c, j
    cuts, i = [], n
    while i:
        i = back[i]
        if i:
            cuts.append(soft[i - 1])
    return cuts[::-1]


def _matcher(values: list[str], escape: bool = True):
    """Occurrences of known values, also with escaped ampersands, by an Aho-Corasick automaton; a longer value weighs a
    little more."""
    import ahocorasick

    auto = ahocorasick.Automaton()
    for v in values:
        for form in {v, v.replace("&", "&amp;")} if escape else {v}:
            auto.add_word(form, len(form))
    if not len(auto):
        return None
    auto.make_automaton()
    return lambda s: [(end + 1 - n, end + 1, min(0.5, n / 1000)) for end, n in auto.iter(s)]


def _long(df: DataFrame, id_col: str, fields: tuple[str, ...], only_packed: bool) -> DataFrame:
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in fields])).alias("p")
    long = df.select(id_col, pairs).select(id_col, "p.field_name", "p.value").where("value IS NOT NULL")
    return long.where(F.col("value").rlike(MAYBE_PACKED)) if only_packed else long


def known_values(long: DataFrame, comma_fields: tuple[str, ...] = COMMA_FIELDS, min_support: int = 2) -> DataFrame:
    """(field_name, term) of whole values that contain a comma, from fields whose terms' ends are beyond doubt, seen in at
    least ``min_support`` rows. A value all of whose parts are known terms of their own is left out: such a text is a list."""

    def harvest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            count: dict[tuple[str, str], int] = {}
            for f, v in zip(b.field_name, b.value):
                terms, sure = parse(v, True)
                if sure:
                    for t in set(terms):
                        count[f, t] = count.get((f, t), 0) + 1
            yield pd.DataFrame([(f, t, n) for (f, t), n in count.items()], columns=["field_name", "term", "n"])

    terms = cut(
        long.where(F.col("field_name").isin(*comma_fields)).select("field_name", "value")
        .mapInPandas(harvest, "field_name string, term string, n bigint")
        .groupBy("field_name", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= min_support),
        "terms",
    )
    packed = terms.where(F.col("term").rlike(f"[{COMMAS}]"))
    single = terms.where(~F.col("term").rlike(f"[{COMMAS}]")).select("field_name", F.col("term").alias("part"))
    parts = packed.select("field_name", "term", F.explode(F.array_distinct(F.transform(F.split("term", f"[{COMMAS}]"), lambda x: F.trim(x)))).alias("part"))
    strange = parts.join(single, ["field_name", "part"], "left_anti").select("field_name", "term").distinct()
    return strange


def split_packed(df: DataFrame, id_col: str = "image_id", fields: tuple[str, ...] = FIELDS, comma_fields: tuple[str, ...] = COMMA_FIELDS, min_terms: int = 1, min_support: int = 2) -> DataFrame:
    """(id, field_name, pos, item_value): each term of each packed field as its own row, ``pos`` from 1 over the
    non-empty terms.

    Null and empty fields give no rows; rows whose id is null are left out; copies of a row count once, and if copies
    of an id differ, the least one counts. Repeated terms count each time. A text of any length is read whole. Columns
    other than the id and the fields are ignored. An empty table gives an empty table. Fields with fewer than
    ``min_terms`` terms are left out.
    """
    rows = cut(one_row_per(df, id_col, list(fields)), "packed-rows")  # read twice below
    values = rows.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("value")) for f in comma_fields])).alias("p")).select("p.*").where("value IS NOT NULL") if comma_fields else None
    long = _long(rows, id_col, fields, min_terms > 1)
    sc = df.sparkSession.sparkContext
    block: dict[str, list[str]] = {}
    spans: Column = F.array().cast("array<string>")
    if values is not None:
        known = cut(known_values(values, comma_fields, min_support), "known")
        size = known.agg(F.coalesce(F.sum(F.octet_length("term") + 60), F.lit(0))).first()[0]
        if size <= BLOCK_BYTES:
            for f, t in known.collect():  # at most BLOCK_BYTES
                block.setdefault(f, []).append(t)
        else:
            long, spans = _with_spans(long, known, -(-size // BLOCK_BYTES), id_col, comma_fields), F.coalesce("spans", spans)
    terms = _terms_udf(sc.broadcast(block), comma_fields)("field_name", "value", spans)
    return (
        long.select(id_col, "field_name", terms.alias("terms")).where(F.size("terms") >= min_terms)
        .select(id_col, "field_name", F.posexplode("terms").alias("pos", "item_value"))
        .select(id_col, "field_name", (F.col("pos") + 1).cast("int").alias("pos"), "item_value")
    )


def _with_spans(long: DataFrame, known: DataFrame, shards: int, id_col: str, comma_fields: tuple[str, ...]) -> DataFrame:
    """``long`` with ``spans``: where known values stand in a field, as "first last weight"; null if nowhere.

    A known value has a comma, so it begins with two parts that also follow each other in a field that holds it. Known
    values are dealt to ``shards`` automata by a hash of these parts, and distinct field values to the automata of their
    own pairs of parts, so each automaton has a bounded size and meets only the fields that may hold its values. Where
    many fields go to one automaton, it is copied for each SHARD_VALUES of them."""
    key = lambda a, b: F.pmod(F.xxhash64("field_name", a, b), F.lit(shards)).cast("int")
    pieces = lambda c: F.transform(F.split(c, f"[{COMMAS}]"), lambda x: F.trim(x))
    forms = known.select("field_name", F.explode(F.array_distinct(F.array("term", F.replace("term", F.lit("&"), F.lit("&amp;"))))).alias("form"))
    forms = forms.withColumn("p", pieces(F.col("form"))).select("field_name", "form", key(F.get("p", 0), F.get("p", 1)).alias("shard"))
    values = long.where(F.col("field_name").isin(*comma_fields) & F.col("value").rlike(f"[{COMMAS}]")).select("field_name", "value").distinct()
    values = values.withColumn("p", pieces(_body(F.col("value")))).where(F.size("p") > 1)
    pairs = F.transform(F.sequence(F.lit(0), F.size("p") - 2), lambda i: key(F.get("p", i), F.get("p", i + 1)))
    values = cut(values.select("field_name", "value", F.explode(F.array_distinct(pairs)).alias("shard")), "packed-values")
    copies = values.groupBy("shard").agg(F.ceil(F.count("*") / F.lit(SHARD_VALUES)).cast("int").alias("copies"))
    left = values.join(copies, "shard").select("field_name", "value", "shard", F.pmod(F.xxhash64("value"), "copies").cast("int").alias("copy"))
    right = forms.join(cut(copies, "copies"), "shard").select("field_name", "form", F.col("shard").alias("to"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("nth"))

    def scan(fields: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        find = {f: m for f, part in words.groupby("field_name") if (m := _matcher(part.form.tolist(), False))}
        rows = [(f, v, [f"{a} {b} {w}" for a, b, w in find[f](body(v))]) for f, v in zip(fields.field_name, fields.value) if f in find]
        return pd.DataFrame([r for r in rows if r[2]], columns=["field_name", "value", "spans"])

    found = left.groupBy("shard", "copy").cogroup(right.groupBy("to", "nth")).applyInPandas(scan, "field_name string, value string, spans array<string>")
    own = F.concat_ws(":", "field_name", "value").alias("_key")
    found = cut(found.groupBy(own).agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    keyed = long.select("*", own)
    return join_hot(keyed, found, "_key", id_col, keyed.groupBy("_key").agg(F.count("*").alias("n")), "left").drop("_key")


def _terms_udf(words, comma_fields: tuple[str, ...]) -> Callable[..., Column]:
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def terms(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        find = {f: m for f, v in words.value.items() if (m := _matcher(v))}
        for field, value, more in batches:
            out = []
            for f, v, extra in zip(field, value, more):
                look = find.get(f)
                if len(extra):
                    known = [(int(a), int(b), float(w)) for a, b, w in (x.split(" ") for x in extra)]
                    base = look
                    look = lambda s, base=base, known=known: known + (base(s) if base else [])
                out.append(parse(v, f in comma_fields, look)[0])
            yield pd.Series(out, dtype=object)

    return terms
