"""Deeply nested semi-structured records: related flat tables that keep parent-child links.

Method: a merged schema is inferred over all records, then each array level it has is exploded recursively into a child
table that carries the parent's surrogate key and the ordinal in the array; every scalar path becomes a column.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType


@dataclass(frozen=True)
class Level:
    """Where a child table's arrays are: ``path`` from the record or the parent's element; ``*`` stands for any key.
    ``shown`` is how the path begins in item_path."""

    table: str
    path: tuple[str, ...]
    shown: str
    children: tuple[Level, ...] = ()


#: The levels of a museum record.
RECORD_LEVELS = (
    Level("freetext", ("content", "freetext", "*"), "freetext"),
    Level("indexed_terms", ("content", "indexedStructured", "*"), "indexedStructured"),
    Level("media", ("content", "descriptiveNonRepeating", "online_media", "media"), "online_media.media", (Level("resources", ("resources",), "resources"),)),
)


def _no_constant(name: str) -> None:
    raise ValueError(f"{name} is no JSON")


def load(text: str | None) -> dict | None:
    """The record in a text, out of its wrapper; None for broken JSON and for anything but an object."""
    if not text:
        return None
    try:
        x = json.loads(text, parse_constant=_no_constant)
    except (ValueError, RecursionError):
        return None
    if isinstance(x, dict) and "content" not in x and isinstance(w := as_object(x.get("record")), dict):
        x = w
    return x if isinstance(x, dict) else None


def as_object(x: object) -> object:
    """An object stored as JSON text, as the object; anything else unchanged."""
    if isinstance(x, str) and x.lstrip()[:1] == "{":
        try:
            y = json.loads(x, parse_constant=_no_constant)
        except (ValueError, RecursionError):
            return x
        return y if isinstance(y, dict) else x
    return x


def as_array(x: object) -> list:
    """An array as it is; null as none; an object or scalar in place of an array as its only element."""
    return x if isinstance(x, list) else [] if x is None else [x]


def _kind(x: object) -> str:
    return "null" if x is None else "object" if isinstance(x, dict) else "array" if isinstance(x, list) else "boolean" if isinstance(x, bool) else "number" if isinstance(x, (int, float)) else "string"


def _utf8(s: str) -> str:
    return s.encode("utf-8", "replace").decode()


def _schema(df: DataFrame, text_col: str, step: Callable[[tuple, object], tuple], shown: Callable[[tuple], str]) -> DataFrame:
    """(path, kind, n) over all records. ``step`` gives the path of a value from its parent's path and its key, None for
    an element of an array; ``shown`` gives the path as text."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            count: dict[tuple[tuple, str], int] = {}
            for text in b[text_col]:
                x = load(text)
                todo = [(("$",), x)] if x is not None else []
                if x is None and text is not None:
                    count[("!broken",), "string"] = count.get((("!broken",), "string"), 0) + 1
                while todo:
                    path, v = todo.pop()
                    v = as_object(v)
                    k = (path, _kind(v))
                    count[k] = count.get(k, 0) + 1
                    if isinstance(v, dict):
                        todo += [(step(path, a), w) for a, w in v.items()]
                    elif isinstance(v, list):
                        below = step(path, None)
                        todo += [(below, w) for w in v]
            yield pd.DataFrame([(shown(p), k, n) for (p, k), n in count.items()], columns=["path", "kind", "n"])

    return df.select(text_col).mapInPandas(walk, "path string, kind string, n bigint").groupBy("path", "kind").agg(F.sum("n").alias("n"))


def infer_schema(df: DataFrame, text_col: str = "record_json") -> DataFrame:
    """(path, kind, n): the merged schema of all records: every path with the kinds of value found there and their
    counts, partial counts made per batch. Object text counts as an object. Broken JSON has the path ``!broken``."""
    return _schema(df, text_col, lambda p, k: (*p[:-1], p[-1] + "[]") if k is None else (*p, k), lambda p: _utf8(".".join(p)))


def infer_levels(df: DataFrame, text_col: str = "record_json", levels: tuple[Level, ...] = RECORD_LEVELS) -> tuple[tuple[Level, ...], dict[str, list[tuple[str, ...]]]]:
    """(levels, columns) of the merged schema. levels: ``levels`` and every other array of the records, a table of its own
    named by its path. columns: for each table, and for ``records``, the paths of its scalars from its element on.

    The keys that ``*`` stands for are one path, so what is collected is as wide as the schema, not as the data. Where some
    record has an array at a place that a given level passes through, that array is no table and stays in ``value``.
    """
    stars = {("$", *x.path[:i]) for x in levels for i, k in enumerate(x.path) if k == "*"}
    found = _schema(df, text_col, lambda p, k: (*p, "*" if k is not None and p in stars else k), lambda p: json.dumps(p[1:])).select("path", "kind").collect()
    kinds = [(tuple(json.loads(r.path)), r.kind) for r in found]
    names: dict[tuple, tuple[str, str]] = {}

    def name(given: tuple[Level, ...], at: tuple) -> None:
        for x in given:
            names[(*at, *x.path)] = (x.table, x.shown)
            name(x.children, (*at, *x.path, None))

    name(levels, ())
    passed = {q[:i] for q in names for i in range(len(q)) if q[i] is not None}
    arrays = {p for p, kind in kinds if kind == "array" and p not in passed} | set(names)

    def whole(path: tuple) -> tuple:
        """``path`` with a step into the element after each array, also where a value stands for its only element."""
        out: list = []
        for k in path:
            while k is not None and tuple(out) in arrays:
                out.append(None)
            out.append(k)
        return tuple(out)

    while (more := {whole(p) for p in arrays}) != arrays:
        arrays = more
    below: dict[tuple, list[tuple]] = {}
    for p in sorted(arrays, key=lambda p: (list(names).index(p) if p in names else len(names), [k or "" for k in p])):
        below.setdefault(_parent(p), []).append(p)
    columns: dict[str, list[tuple[str, ...]]] = {}
    tables: dict[tuple, str] = {(): "records"}

    def build(at: tuple, prefix: str) -> tuple[Level, ...]:
        out = []
        for p in below.get(at, []):
            own = p[len(at) :]
            table, shown = names.get(p, (f"{prefix}.{'.'.join(own)}" if prefix and own else prefix + "[]" if prefix else ".".join(own), ".".join(own)))
            while table in tables.values():
                table += "_"
            tables[*p, None] = table
            out.append(Level(table, own, shown, build((*p, None), table)))
        return tuple(out)

    made = build((), "")
    for p in sorted({whole(p) for p, kind in kinds if kind in ("string", "number", "boolean")} - arrays, key=lambda p: [k or "" for k in p]):
        if own := p[len(_parent(p)) :]:
            columns.setdefault(tables[_parent(p)], []).append(own)
    return made, columns


def _parent(path: tuple) -> tuple:
    """The path up to its last step into an element."""
    return path[: max((i + 1 for i, k in enumerate(path) if k is None), default=0)]


def _elements(x: object, path: tuple[str, ...], shown: str) -> list[tuple[str, list]]:
    """(shown path, array) of each array at ``path`` below ``x``."""
    found = [(shown, x)]
    for step in path:
        below = []
        for name, v in found:
            v = as_object(v)
            if isinstance(v, dict):
                below += [(f"{name}.{k}", w) for k, w in v.items()] if step == "*" else [(name, v[step])] if step in v else []
        found = below
    return [(name, as_array(v)) for name, v in found]


def _nodes(x: object, levels: tuple[Level, ...], parent: str = "") -> Iterator[tuple[Level, str, str, int, object]]:
    """(level, item_path, parent_path, ordinal, element) of each non-null element, a parent before its children."""
    for level in levels:
        begin = f"{parent}.{level.shown}" if parent and level.shown else parent + level.shown
        for name, items in _elements(x, level.path, begin):
            name = _utf8(name)
            for i, v in enumerate(items):
                if v is not None:
                    v = as_object(v)
                    yield level, (path := f"{name}[{i}]"), parent, i, v
                    yield from _nodes(v, level.children, path)


def _without(x: object, levels: tuple[Level, ...]) -> object:
    """``x`` without the arrays of ``levels``; ``x`` itself isn't changed."""
    for level in levels:
        x = _drop(x, level.path)
    return x


def _drop(x: object, path: tuple[str, ...]) -> object:
    if not path:
        return [] if isinstance(x, list) else x
    y = as_object(x)
    if not isinstance(y, dict):
        return x
    gone = set(y) if path[0] == "*" else {path[0]} & set(y)
    if len(path) == 1:
        return {k: v for k, v in y.items() if k not in gone}
    return {k: _drop(v, path[1:]) if k in gone else v for k, v in y.items()} if gone else x


def _json(x: object) -> str:
    return json.dumps(x, separators=(",", ":"))


def _text(x: object) -> str | None:
    return None if x is None else _utf8(x if isinstance(x, str) else json.dumps(x))


def _label(x: object) -> str | None:
    return _text(x.get("label")) if isinstance(x, dict) else None


def _content(x: object) -> str | None:
    return _text(x.get("content") if isinstance(x, dict) else x)


def _scalar(x: object, path: tuple[str, ...]) -> str | None:
    """The scalar at ``path`` as text, objects in text read on the way."""
    for k in path:
        x = as_object(x)
        if not isinstance(x, dict):
            return None
        x = x.get(k)
    x = as_object(x)
    return None if isinstance(x, (dict, list)) else _text(x)


def _once(df: DataFrame, id_col: str, text_col: str, unique_ids: bool = False) -> DataFrame:
    once = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col)
    return once if unique_ids else once.groupBy(id_col).agg(F.min(text_col).alias(text_col))


def explode_levels(df: DataFrame, id_col: str = "line_id", text_col: str = "record_json", levels: tuple[Level, ...] = RECORD_LEVELS, with_values: bool = True, unique_ids: bool = False) -> DataFrame:
    """All child tables in one long table: (id, table, item_path, parent_path, ordinal, label, content, value).

    One row for each non-null element of each array of ``levels``; ``ordinal`` is its position from 0 in the stored
    array, nulls counted; ``parent_path`` is the parent element's item_path, or empty where the record itself is the
    parent, so (id, parent_path) is the parent's key. An object or scalar in place of an array is element 0; an object
    stored as JSON text is read as one. ``value`` is the element as JSON without its child arrays; ``label`` and
    ``content`` are those of an object, ``content`` the scalar itself otherwise. Null or broken JSON and null ids give
    no rows; copies of an id count once (the least text), for which all texts are shuffled unless ``unique_ids`` says
    there are none; an empty table gives an empty table.
    """

    def explode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[tuple] = []
            for key, text in zip(b[id_col], b[text_col]):
                if (x := load(text)) is not None:
                    for level, path, parent, i, v in _nodes(x, levels):
                        shown = (_label(v), _content(v), _json(_without(v, level.children))) if with_values else (None, None, None)
                        rows.append((key, level.table, path, parent, i, *shown))
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    names = [id_col, "table", "item_path", "parent_path", "ordinal", "label", "content", "value"]
    kind = df.schema[id_col].dataType.simpleString()
    return _once(df, id_col, text_col, unique_ids).mapInPandas(explode, f"{id_col} {kind}, table string, item_path string, parent_path string, ordinal int, label string, content string, value string")


#: The columns that have names of their own, in this order; every other scalar path of the schema comes after them.
_DNR = ("content", "descriptiveNonRepeating")
FIELDS: dict[str, dict[str, tuple[str, ...]]] = {
    "records": {"record_id": ("id",), "unit_code": ("unitCode",), "title": ("title",), "type": ("type",), "hash": ("hash",), "object_id": (*_DNR, "record_ID"), "data_source": (*_DNR, "data_source"), "metadata_access": (*_DNR, "metadata_usage", "access")},
    "freetext": {"label": ("label",), "content": ("content",)},
    "indexed_terms": {"content": ("content",)},
    "media": {n: (n,) for n in ("id", "idsId", "guid", "type", "caption", "thumbnail", "content")} | {"access": ("usage", "access")},
    "resources": {n: (n,) for n in ("label", "url", "width", "height")},
}
NUMBERS = {"resources": ("width", "height")}


def flat_tables(df: DataFrame, id_col: str = "line_id", text_col: str = "record_json") -> dict[str, DataFrame]:
    """The related tables of museum records: records, freetext, indexed_terms, media, resources, and one more for each
    other array of the merged schema. ``key`` is a row's surrogate key and ``parent_key`` its parent's; a record's key is
    its id as text. Every scalar path of the merged schema is a column: those of FIELDS under their names, the others
    under their path joined by ``_``. ``content`` is the element itself where that is a scalar; ``value`` is the row
    as JSON without its child arrays. The schema is inferred when this is called."""
    levels, columns = infer_levels(df, text_col)
    once = _once(df, id_col, text_col)
    out = {"records": _flat(once, id_col, text_col, "records", levels, columns)}

    def add(given: tuple[Level, ...]) -> None:
        for x in given:
            out[x.table] = _flat(once, id_col, text_col, x.table, levels, columns)
            add(x.children)

    add(levels)
    return out


def _flat(once: DataFrame, id_col: str, text_col: str, table: str, levels: tuple[Level, ...], columns: dict[str, list[tuple[str, ...]]]) -> DataFrame:
    fields = dict(FIELDS.get(table, {"content": ("content",)}))
    head = [id_col, "key"] if table == "records" else [id_col, "key", "parent_key", "item_path", "ordinal", *(["group"] if table in ("freetext", "indexed_terms") else [])]
    known, taken = set(fields.values()), {x.lower() for x in (*head, *fields, "value")}
    for path in columns.get(table, []):
        if path not in known:
            name = _utf8("_".join(path)) or "_"
            while name.lower() in taken:
                name += "_"
            taken.add(name.lower())
            fields[name] = path
    paths = [None if p == ("content",) and table != "records" else p for p in fields.values()]
    shape = StructType([once.schema[id_col], StructField("item_path", StringType()), StructField("parent_path", StringType()), StructField("ordinal", IntegerType()), *[StructField(f"f{i}", StringType()) for i in range(len(paths))], StructField("value", StringType())])
    names = shape.names

    def rows_of(x: dict) -> Iterator[tuple]:
        if table == "records":
            yield "", "", 0, *[_scalar(x, p) for p in paths], _json(_without(x, levels))
            return
        for level, path, parent, i, v in _nodes(x, levels):
            if level.table == table:
                yield path, parent, i, *[_content(v) if p is None else _scalar(v, p) for p in paths], _json(_without(v, level.children))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows: list[tuple] = []
            for key, text in zip(b[id_col], b[text_col]):
                if (x := load(text)) is not None:
                    rows += [(key, *r) for r in rows_of(x)]
                if len(rows) > 20_000:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    text = F.col(id_col).cast("string")
    made = {
        id_col: F.col(id_col),
        "key": text if table == "records" else F.concat_ws(":", text, "item_path"),
        "parent_key": F.concat_ws(":", text, F.nullif("parent_path", F.lit(""))),
        "item_path": F.col("item_path"),
        "ordinal": F.col("ordinal"),
        "group": F.regexp_extract("item_path", r"^[^.]+\.(.*)\[\d+\]$", 1),
    }
    number = NUMBERS.get(table, ())
    cells = [(F.expr(f"try_cast(f{i} AS bigint)") if n in number else F.col(f"f{i}")).alias(n) for i, n in enumerate(fields)]
    return once.mapInPandas(read, shape).select(*[made[n].alias(n) for n in head], *cells, "value")
