"""SQL of the flattened candidates: the same fields, written with lists and JSON paths."""

from __future__ import annotations

from siftwork.operators import flatten
from siftwork.plans.packed_nested import _ARR, _RECORDS, _obj

SPACE = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1c}-\x{1f}]+"
HOST = "ids.museum.example"


def _text(x: str) -> str:
    return f"CASE WHEN json_type({x}) = 'VARCHAR' THEN ({x}) ->> '$' WHEN json_type({x}) IN ('OBJECT', 'ARRAY', 'NULL') THEN NULL ELSE CAST({x} AS VARCHAR) END"


def _clean(t: str) -> str:
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        t = f"replace({t}, '{entity}', '{char}')"
    return f"nullif(trim(regexp_replace(regexp_replace({t}, '<[^>]+>', '', 'g'), '{SPACE}', ' ', 'g')), '')"


def _value(x: str) -> str:
    return _clean(_text(x))


def _first(*xs: str) -> str:
    return "coalesce(" + ", ".join(map(_value, xs)) + ")"


def _objects(x: str) -> str:
    return f"list_filter(list_transform({_ARR.format(x=f'({x})')}, lambda i: {_obj('i')}), lambda i: json_type(i) = 'OBJECT')"


def _free(group: str, needles: tuple[str, ...] = ()) -> str:
    items = _objects(f"f -> '$.{group}'")
    if needles:
        label = "lower(coalesce(" + _value("i -> '$.label'") + ", ''))"
        items = f"list_filter({items}, lambda i: " + " OR ".join(f"contains({label}, '{n}')" for n in needles) + ")"
    return f"list_transform({items}, lambda i: {_value(_path('i', 'content'))})"


def _path(x: str, key: str) -> str:
    return f"{x} -> '$.{key}'"


def _indexed(key: str) -> str:
    x = f"(g -> '$.{key}')"
    return f"list_transform(list_filter({_ARR.format(x=x)}, lambda i: json_type(i) NOT IN ('OBJECT', 'ARRAY', 'NULL')), lambda i: {_value('i')})"


def _long(x: str) -> str:
    t = f"trim(({x}) ->> '$')"
    return f"CASE WHEN json_type({x}) IN ('BIGINT', 'UBIGINT') THEN TRY_CAST({x} AS BIGINT) WHEN json_type({x}) = 'VARCHAR' AND regexp_full_match({t}, '[+-]?[0-9]+') THEN TRY_CAST({t} AS BIGINT) END"


def url(c: str, side: int) -> str:
    return f"""CASE WHEN lower(regexp_extract({c}, '^[^:/?#]+://([^/?#]*)', 1)) <> '{HOST}' THEN {c}
 WHEN regexp_matches({c}, '/ids/deliveryService/?\\?(.*&)?id=') THEN CASE WHEN regexp_matches({c}, '[?&]max=') THEN regexp_replace({c}, '([?&])max=[^&]*', '\\1max={side}') ELSE {c} || '&max={side}' END
 WHEN contains({c}, '/ids/deliveryService/id/') THEN regexp_replace(rtrim({c}, '/'), '/[0-9]+$', '') || '/{side}' ELSE {c} END"""


def _lists() -> dict[str, str]:
    out = {name: _free(*spec) for name, spec in flatten.LABELS.items()}
    out |= {name: _indexed(key) for name, key in flatten.INDEXED.items()}
    for name, (key, group, _) in flatten.EITHER.items():
        out |= {f"{name}_i": _indexed(key), f"{name}_f": _free(group)}
    return out


def _joined(name: str) -> str:
    if name not in flatten.EITHER:
        return name
    order = (f"{name}_i", f"{name}_f") if flatten.EITHER[name][2] else (f"{name}_f", f"{name}_i")
    return f"coalesce({order[0]}, {order[1]})"


def _columns() -> dict[str, str]:
    usage = lambda x, key: f"{_obj(_path(x, key))} -> '$.access'"
    out = {n: _joined(n) for n in (*flatten.LABELS, *flatten.INDEXED, *flatten.EITHER)}
    out |= {
        "object_id": _first("x -> '$.record_ID'", "j -> '$.url'", "j -> '$.id'"), "edan_id": _value("j -> '$.id'"), "media_id": _first("m -> '$.id'", "m -> '$.idsId'", "m -> '$.guid'"), "ids_id": _value("m -> '$.idsId'"),
        "unit_code": _first("x -> '$.unit_code'", "j -> '$.unitCode'"), "title": _first(f"{_obj(_path('x', 'title'))} -> '$.content'", "j -> '$.title'"), "institution": _value("x -> '$.data_source'"),
        "source_url": _first("x -> '$.record_link'", "x -> '$.guid'"), "record_guid": _value("x -> '$.guid'"), "media_guid": _value("m -> '$.guid'"), "media_url": _value("m -> '$.content'"), "thumbnail_url": _value("m -> '$.thumbnail'"),
        "media_type": _value("m -> '$.type'"), "media_rights": _value(usage("m", "usage")), "metadata_rights": _value(usage("x", "metadata_usage")), "media_caption": _value("m -> '$.caption'"),
        "alt_text": _value("m -> '$.altTextAccessibility'"), "media_description": _value("m -> '$.extDescrAccessibility'"), "record_type": _value("j -> '$.type'"), "record_hash": _value("j -> '$.hash'"), "raw_category": "usage_flags",
    }
    for label, name in flatten.RESOURCES.items():
        low = "lower(" + _value("i -> '$.label'") + ")"
        out[name] = _value(f"(list_filter(res, lambda i: {low} = '{label}')[-1]) -> '$.url'")
    out |= {"record_timestamp": _long("j -> '$.timestamp'"), "record_last_updated": _long("j -> '$.lastTimeUpdated'")}
    for side in ("width", "height"):
        out[f"source_{side}"] = _long(f"(list_filter(res, lambda i: coalesce(json_type(i -> '$.{side}'), 'NULL') <> 'NULL')[1]) -> '$.{side}'")
    return out


_NAMES = list(_lists())
CANDIDATES = f"""WITH {_RECORDS},
 h AS (SELECT w.line_id, j, x, {_obj("c -> '$.freetext'")} AS f, {_obj("c -> '$.indexedStructured'")} AS g, {_obj("x -> '$.online_media'")} AS o FROM w JOIN r USING (line_id) JOIN n USING (line_id) WHERE json_type(j) = 'OBJECT' AND {_value(_obj("x -> '$.metadata_usage'") + " -> '$.access'")} = 'CC0'),
 k AS MATERIALIZED (SELECT line_id, j, x, o, {", ".join(f"list_filter({e}, lambda v: v IS NOT NULL) AS {n}" for n, e in _lists().items())} FROM h),
 l AS (SELECT line_id, j, x, o, {", ".join(f"nullif(array_to_string(list_filter({n}, lambda v, i: list_position({n}, v) = i), '; '), '') AS {n}" for n in _NAMES)} FROM k),
 e AS (SELECT * EXCLUDE (items), unnest(items) AS item, generate_subscripts(items, 1) - 1 AS media_pos FROM (SELECT *, {_ARR.format(x="(o -> '$.media')")} AS items FROM l)),
 q AS (SELECT * EXCLUDE (item), {_obj("item")} AS m FROM e WHERE item IS NOT NULL),
 s AS MATERIALIZED (SELECT *, {_objects("m -> '$.resources'")} AS res FROM q WHERE json_type(m) = 'OBJECT' AND m ->> '$.type' = 'Images' AND {_obj("m -> '$.usage'")} ->> '$.access' = 'CC0')
 SELECT *, {url("media_url", 512)} AS image_url FROM (SELECT line_id, CAST(media_pos AS INT) AS media_pos, {", ".join(f"{e} AS {n}" for n, e in _columns().items())} FROM s)"""

_KEYS = ("object_id", "media_id", "media_url")
_ONE = f"(SELECT DISTINCT {', '.join(_KEYS)} FROM ({CANDIDATES}))"


def identified(seed: str) -> str:
    h = f"sha256('{seed}:' || " + " || '|' || ".join(f"coalesce({k}, '')" for k in _KEYS) + ")"
    return f"SELECT image_id, lpad(CAST(image_id AS VARCHAR), 8, '0') || '.jpg' AS file_name, h AS selection_hash, {', '.join(_KEYS)} FROM (SELECT *, row_number() OVER (ORDER BY h, {', '.join(_KEYS)}) AS image_id FROM (SELECT *, {h} AS h FROM {_ONE}))"
