"""Image checks, normalisation and fetching. Decoding runs on Spark's image source; encoding needs Pillow, if installed."""

from __future__ import annotations

import hashlib
import io
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwork.functions.values import perceptual_hash


def image_checks(width: str = "width", height: str = "height", expected_width: str | None = None, expected_height: str | None = None, least_side: int = 256, extreme: float = 8.0, deviation: str | None = None, least_deviation: float = 2.0) -> Column:
    """struct(errors, flags): hard errors of a decoded image, and flags for an extreme aspect or a blank picture."""
    w, h = F.col(width), F.col(height)
    errors = [F.when(w.isNull() | h.isNull(), "DECODE_FAILURE"), F.when(F.greatest(w, h) < least_side, "TOO_SMALL")]
    if expected_width and expected_height:
        errors.append(F.when((w != F.col(expected_width)) | (h != F.col(expected_height)), "DIMENSION_MISMATCH"))
    ratio = F.try_divide(w.cast("double"), h.cast("double"))
    flags = [F.when((ratio > extreme) | (ratio < 1 / extreme), "EXTREME_ASPECT")]
    if deviation:
        flags.append(F.when(F.col(deviation) < least_deviation, "LOW_VARIATION"))
    return F.struct(F.array_compact(F.array(*errors)).alias("errors"), F.array_compact(F.array(*flags)).alias("flags"))


@F.pandas_udf(T.DoubleType())
def grey_deviation(data: pd.Series, width: pd.Series, height: pd.Series, channels: pd.Series) -> pd.Series:
    """Standard deviation of the grey values, on at most about 128 by 128 of the pixels."""
    out = []
    for d, w, h, c in zip(data, width, height, channels):
        px = np.frombuffer(d, dtype=np.uint8).reshape(h, w, c)[:: max(1, h // 128), :: max(1, w // 128)].astype(np.float64)
        grey = px[..., 0] if c == 1 else 0.114 * px[..., 0] + 0.587 * px[..., 1] + 0.299 * px[..., 2]
        out.append(float(grey.std()))
    return pd.Series(out)


def normalize_jpeg(content: bytes, most: int = 512, least: int = 256, quality: int = 84) -> dict:
    """One image upright, on white, scaled down to ``most`` and encoded as JPEG, with its sizes and hashes. Needs
    Pillow."""
    if most <= 0 or least < 0 or not 1 <= quality <= 95:
        raise ValueError("most must be positive, least not negative, quality from 1 to 95")
    from PIL import Image, ImageOps

    with Image.open(io.BytesIO(content)) as raw:
        img = ImageOps.exif_transpose(raw)
        if "A" in img.getbands() or "transparency" in img.info:
            img = img.convert("RGBA")
            white = Image.new("RGBA", img.size, "white")
            img = Image.alpha_composite(white, img)
        img = img.convert("RGB")
    if max(img.size) < least:
        raise ValueError("image too small")
    img.thumbnail((most, most))
    grey = perceptual_hash(np.asarray(img.convert("L")))
    buffer = io.BytesIO()
    img.save(buffer, "JPEG", quality=quality, optimize=True)
    data = buffer.getvalue()
    with Image.open(io.BytesIO(data)) as again:
        again.load()
    return {"data": data, "width": img.size[0], "height": img.size[1], "sha256": hashlib.sha256(data).hexdigest(), "phash": grey, "final_bytes": len(data)}


NORMALIZED = "status string, error string, data binary, width int, height int, sha256 string, phash string, final_bytes bigint"


def normalize_images(df: DataFrame, id_col: str = "image_id", content: str = "content", most: int = 512, least: int = 256, quality: int = 84) -> DataFrame:
    """(id, status, error, data, width, height, sha256, phash, final_bytes): :func:`normalize_jpeg` for each row; an image
    that can't be read or is too small is a failure with its error. Needs Pillow on the executors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key, raw in zip(b[id_col], b[content]):
                try:
                    x = normalize_jpeg(bytes(raw or b""), most, least, quality)
                    rows.append((key, "success", None, x["data"], x["width"], x["height"], x["sha256"], x["phash"], x["final_bytes"]))
                except ImportError:
                    raise
                except Exception as e:  # noqa: BLE001 - whatever a broken image raises
                    rows.append((key, "failed", f"{type(e).__name__}: {e}"[:200], None, None, None, None, None, None))
            frame = pd.DataFrame(rows, columns=[id_col, *(c.split(" ")[0] for c in NORMALIZED.split(", "))])
            yield frame.astype({"width": "Int64", "height": "Int64", "final_bytes": "Int64"})

    return df.select(id_col, content).mapInPandas(run, f"{id_col} {df.schema[id_col].dataType.simpleString()}, {NORMALIZED}")


# HTTP answers after which another attempt is made.
RETRYABLE = (408, 425, 429, 500, 502, 503, 504)


@dataclass(frozen=True)
class Answer:
    status: int
    mime: str = ""
    body: bytes = b""


FETCHED = "image_id bigint, status string, http_status int, attempts int, error string, bytes bigint, sha256 string, mime string, retryable boolean, seconds double"


def fetch(df: DataFrame, get: Callable[[str], Answer], id_col: str = "image_id", url: str = "image_url", attempts: int = 4, backoff: float = 0.5, most_bytes: int = 52_428_800, parallel: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """An audit row per image, with the columns of ``keep`` carried over; ``retryable`` tells whether a later run may
    succeed: ``get`` is called for each address, again after an answer that may change, with the wait
    doubled each time. Answers that aren't images, empty addresses and bodies beyond the cap are failures. The number of
    partitions bounds the parallel calls."""

    def one(address: str | None) -> tuple:
        if not address:
            return "failed", None, 0, "MISSING_IMAGE_URL", None, None, None, False
        error, code, mime = None, None, None
        for n in range(1, attempts + 1):
            try:
                answer = get(address)
            except OSError as e:
                code, mime, error = None, None, f"{type(e).__name__}: {e}"[:200]
            except Exception as e:  # noqa: BLE001 - such an error won't go away by itself
                return "failed", None, n, f"{type(e).__name__}: {e}"[:200], None, None, None, False
            else:
                code, mime = answer.status, answer.mime
                if code == 200:
                    if not mime.lower().startswith("image/"):
                        return "failed", code, n, f"UNEXPECTED_MIME:{mime}"[:200], None, None, mime, False
                    if len(answer.body) > most_bytes:
                        return "failed", code, n, "TOO_LARGE", len(answer.body), None, mime, False
                    return "success", code, n, None, len(answer.body), hashlib.sha256(answer.body).hexdigest(), mime, False
                error = f"HTTP_{code}"
                if code not in RETRYABLE:
                    return "failed", code, n, error, None, None, mime, False
            if n < attempts:
                time.sleep(backoff * 2 ** (n - 1))
        return "failed", code, attempts, error, None, None, mime, True

    def timed(address: str | None) -> tuple:
        began = time.monotonic()
        return *one(address), time.monotonic() - began

    names = [x.split(" ")[0] for x in FETCHED.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            frame = pd.DataFrame([(k, *timed(u)) for k, u in zip(b["_id"], b["_url"])], columns=names)
            for c in ("http_status", "bytes"):
                frame[c] = frame[c].astype("Int64")
            for i, c in enumerate(keep):
                frame[c] = b[f"_k{i}"].to_numpy()
            yield frame

    rows = df.select(F.col(id_col).alias("_id"), F.col(url).alias("_url"), *[F.col(c).alias(f"_k{i}") for i, c in enumerate(keep)])
    shape = FETCHED + "".join(f", `{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    return (rows.repartition(parallel) if parallel else rows).mapInPandas(run, shape)


def embed(df: DataFrame, model: Callable[[list[bytes]], np.ndarray], id_col: str = "image_id", content: str = "content", batch: int = 128) -> DataFrame:
    """(id, embedding): unit vectors of the images' contents by a model given as a function over a batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for k in range(0, len(b), batch):
                part = b.iloc[k : k + batch]
                v = np.asarray(model(list(part[content])), dtype=np.float32)
                if v.ndim != 2:
                    raise ValueError("the model must return a row per image")
                v = v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
                yield pd.DataFrame({id_col: part[id_col].to_numpy(), "embedding": list(v)})

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, content).mapInPandas(run, f"{id_col} {kind}, embedding array<float>")
