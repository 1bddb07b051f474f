"""Nested museum records to flat candidates: one row per object and image."""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.functions.text import derivative_url
from siftwork.functions.values import file_name, seeded_sha
from siftwork.operators.nested import as_array, as_object, load
from siftwork.operators.sampling import global_rank

_TAG = re.compile(r"<[^>]+>")

# Which labels of a free-text group feed a field, and where a field comes from first.
LABELS = {
    "description": ("notes", ("description", "summary")),
    "creator": ("name", ("artist", "maker", "manufacturer", "creator", "designer", "author", "photographer")),
    "related_names": ("name", ()),
    "collection": ("setName", ("see more items in", "collection")),
    "physical_description": ("physicalDescription", ("physical description", "medium")),
    "credit_line": ("creditLine", ()),
    "object_rights": ("objectRights", ()),
}
INDEXED = {"topics": "topic", "culture": "culture", "usage_flags": "usage_flag", "indexed_media_rights": "online_media_rights"}
#: field -> (indexed key, free-text group, indexed first)
EITHER = {"object_type": ("object_type", "objectType", True), "date": ("date", "date", False), "place": ("place", "place", True), "scientific_name": ("scientific_name", "taxonomicName", True)}
RESOURCES = {"high-resolution jpeg": "highres_jpeg_url", "screen image": "screen_url", "thumbnail image": "thumbnail_resource_url"}

TEXT_COLUMNS = (
    "object_id edan_id media_id ids_id unit_code title description object_type institution collection creator related_names date place topics culture scientific_name physical_description credit_line usage_flags "
    "source_url record_guid media_guid media_url thumbnail_url media_type media_rights metadata_rights object_rights indexed_media_rights media_caption alt_text media_description record_type record_hash raw_category "
    "highres_jpeg_url screen_url thumbnail_resource_url"
).split()
LONG_COLUMNS = ("record_timestamp", "record_last_updated", "source_width", "source_height")


def clean(v: object) -> str | None:
    """As :func:`siftwork.functions.text.clean_text`, for one value inside a record."""
    if v is None or isinstance(v, (dict, list)):
        return None
    t = " ".join(_TAG.sub("", html.unescape(v if isinstance(v, str) else json.dumps(v))).split())
    return t.encode("utf-8", "replace").decode() or None


def _distinct(values: list) -> list[str]:
    return list(dict.fromkeys(x for v in values if (x := clean(v))))


def _object(x: object, *path: str) -> dict:
    for step in path:
        x = as_object(as_object(x).get(step)) if isinstance(as_object(x), dict) else None
    x = as_object(x)
    return x if isinstance(x, dict) else {}


def _free(record: dict, group: str, needles: Sequence[str] = ()) -> list[str]:
    items = [as_object(i) for i in as_array(_object(record, "content", "freetext").get(group))]
    return _distinct([i.get("content") for i in items if isinstance(i, dict) and (not needles or any(n in (clean(i.get("label")) or "").casefold() for n in needles))])


def _indexed(record: dict, key: str) -> list[str]:
    return _distinct([v for v in as_array(_object(record, "content", "indexedStructured").get(key)) if isinstance(v, (str, int, float))])


def _long(v: object) -> int | None:
    try:
        n = int(v) if isinstance(v, (int, str)) and v != "" else None
    except ValueError:
        return None
    return n if n is not None and -(2**63) <= n < 2**63 else None


def candidate(record: dict, media: dict) -> dict:
    """The fields of one object and image, without the rendition's address."""
    dnr = _object(record, "content", "descriptiveNonRepeating")
    join = lambda values: "; ".join(values) or None
    out: dict = {f: join(_free(record, *spec)) for f, spec in LABELS.items()}
    out |= {f: join(_indexed(record, key)) for f, key in INDEXED.items()}
    for f, (key, group, indexed_first) in EITHER.items():
        a, b = (lambda: _indexed(record, key)), (lambda: _free(record, group))
        out[f] = join((a() or b()) if indexed_first else (b() or a()))
    first = lambda *values: next((x for v in values if (x := clean(v))), None)
    out |= {
        "object_id": first(dnr.get("record_ID"), record.get("url"), record.get("id")), "edan_id": clean(record.get("id")), "media_id": first(media.get("id"), media.get("idsId"), media.get("guid")), "ids_id": clean(media.get("idsId")),
        "unit_code": first(dnr.get("unit_code"), record.get("unitCode")), "title": first(_object(dnr, "title").get("content"), record.get("title")), "institution": clean(dnr.get("data_source")),
        "source_url": first(dnr.get("record_link"), dnr.get("guid")), "record_guid": clean(dnr.get("guid")), "media_guid": clean(media.get("guid")), "media_url": clean(media.get("content")), "thumbnail_url": clean(media.get("thumbnail")),
        "media_type": clean(media.get("type")), "media_rights": clean(_object(media, "usage").get("access")), "metadata_rights": clean(_object(dnr, "metadata_usage").get("access")), "media_caption": clean(media.get("caption")),
        "alt_text": clean(media.get("altTextAccessibility")), "media_description": clean(media.get("extDescrAccessibility")), "record_type": clean(record.get("type")), "record_hash": clean(record.get("hash")),
        "record_timestamp": _long(record.get("timestamp")), "record_last_updated": _long(record.get("lastTimeUpdated")), "raw_category": out["usage_flags"],
    }
    resources = [r for x in as_array(media.get("resources")) if isinstance(r := as_object(x), dict)]
    for side in ("width", "height"):
        out[f"source_{side}"] = _long(next((r[side] for r in resources if r.get(side) is not None), None))
    out |= dict.fromkeys(RESOURCES.values())
    for r in resources:
        if name := RESOURCES.get((clean(r.get("label")) or "").casefold()):
            out[name] = clean(r.get("url"))
    return out


def candidates(df: DataFrame, id_col: str = "line_id", text_col: str = "record_json", open_only: bool = True, open_access: str = "CC0", image_type: str = "Images", host: str = "", side: int = 512) -> DataFrame:
    """One row per record and image: the id, ``media_pos``, the flattened fields and ``image_url``.

    Only media of type ``image_type`` count; with ``open_only`` record and media must both have ``open_access``. Records
    are read as :func:`siftwork.operators.nested.explode_levels` reads them. Null and broken records give no rows.
    """
    names = [id_col, "media_pos", *TEXT_COLUMNS, *LONG_COLUMNS]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, text in zip(b[id_col], b[text_col]):
                record = load(text)
                if record is None or open_only and clean(_object(record, "content", "descriptiveNonRepeating", "metadata_usage").get("access")) != open_access:
                    continue
                for pos, m in enumerate(as_array(_object(record, "content", "descriptiveNonRepeating", "online_media").get("media"))):
                    m = as_object(m)
                    if isinstance(m, dict) and m.get("type") == image_type and (not open_only or _object(m, "usage").get("access") == open_access):
                        rows.append({id_col: key, "media_pos": pos} | candidate(record, m))
            frame = pd.DataFrame(rows, columns=names)
            for c in LONG_COLUMNS:
                frame[c] = frame[c].astype("Int64")
            yield frame

    kind = df.schema[id_col].dataType.simpleString()
    shape = f"{id_col} {kind}, media_pos int, " + ", ".join(f"`{c}` string" for c in TEXT_COLUMNS) + ", " + ", ".join(f"`{c}` bigint" for c in LONG_COLUMNS)
    flat = df.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(id_col, text_col).mapInPandas(run, shape)
    return flat.withColumn("image_url", derivative_url("media_url", host, side) if host else F.col("media_url"))


def identify(df: DataFrame, seed: str, keys: Sequence[str] = ("object_id", "media_id", "media_url")) -> DataFrame:
    """``df`` with ``selection_hash``, ``image_id`` (rank from 1 by hash and keys) and ``file_name``."""
    hashed = df.withColumn("selection_hash", seeded_sha(seed, list(keys)))
    return global_rank(hashed, ["selection_hash", *keys], "image_id").withColumn("file_name", file_name("image_id"))


def preserved_records(df: DataFrame, emitted: DataFrame, id_col: str = "line_id", text_col: str = "record_json") -> DataFrame:
    """The source records that gave at least one candidate, wrapped as JSON with unit and shard."""
    kept = df.join(emitted.select(id_col).distinct(), id_col, "left_semi")
    return kept.select(F.to_json(F.struct("source_unit", "source_shard_url", F.col(text_col).alias("record"))).alias("value"))
