"""Hashes, numbers, vectors and perceptual hashes."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def seeded_sha(seed: str, columns: Sequence[Column | str], sep: str = "|", null_as: str = "") -> Column:
    """Hex SHA-256 of ``seed:a|b|c``; a null renders as ``null_as``."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(null_as)) for c in columns]
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.concat_ws(sep, *parts)), 256)


def ratio(a: Column | str, b: Column | str, digits: int | None = None) -> Column:
    """a / b as a double, 0.0 where b is 0 or null; rounded half to even where ``digits`` is given."""
    q = F.coalesce(F.try_divide(_col(a).cast("double"), _col(b).cast("double")), F.lit(0.0))
    return q if digits is None else F.bround(q, digits)


def file_name(c: Column | str, suffix: str = ".jpg") -> Column:
    return F.format_string(f"%08d{suffix}", _col(c).cast("bigint"))


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(F.aggregate(_col(a), F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def l2_normalize(a: Column | str, eps: float = 1e-12) -> Column:
    n = F.greatest(norm(a), F.lit(eps))
    return F.transform(_col(a), lambda x: x.cast("double") / n)


def hamming(a: Column | str, b: Column | str) -> Column:
    return F.bit_count(_col(a).bitwiseXOR(_col(b)))


def hex_bits(c: Column | str) -> Column:
    """16 hex digits as a signed 64-bit integer; null for anything else."""
    h = F.lower(F.trim(_col(c)))
    return F.when(h.rlike("^[0-9a-f]{16}$"), F.conv(h, 16, -10).cast("bigint"))


def _dct(n: int) -> np.ndarray:
    k, i = np.arange(n)[:, None], np.arange(n)[None, :]
    return np.cos(np.pi * k * (2 * i + 1) / (2 * n))


def perceptual_hash(pixels: np.ndarray, size: int = 8, factor: int = 4) -> str:
    """Hex DCT hash of a grey image of 0 to 255: scaled by a windowed sinc to (size * factor) squared, first along the
    rows and then along the columns, in whole grey values each time; the low frequencies are compared with their median,
    the constant one left out of the median."""
    if size < 2 or factor < 1:
        raise ValueError("size must be at least 2 and factor at least 1")
    side = size * factor
    whole = lambda x: np.clip(np.floor(x + 0.5), 0, 255)
    small = whole(_weights(side, pixels.shape[0]) @ whole(pixels.astype(np.float64) @ _weights(side, pixels.shape[1]).T))
    basis = _dct(side)
    low = (basis @ small @ basis.T)[:size, :size].ravel()
    bits = low > np.median(low[1:])
    return f"{int(''.join('1' if b else '0' for b in bits), 2):0{size * size // 4}x}"


def _weights(to: int, n: int, lobes: int = 3) -> np.ndarray:
    """Rows that make ``to`` pixels of ``n``: a sinc windowed by its own first lobe, widened where the picture shrinks."""
    scale = n / to
    x = (np.arange(n) + 0.5 - (np.arange(to)[:, None] + 0.5) * scale) / max(scale, 1.0)
    w = np.where(np.abs(x) < lobes, np.sinc(x) * np.sinc(x / lobes), 0.0)
    return w / w.sum(axis=1, keepdims=True)


# Parts of red, green and blue in a grey value, in 65,536ths.
GREY = (19595, 38470, 7471)


@F.pandas_udf(T.StringType())
def grey_phash(data: pd.Series, width: pd.Series, height: pd.Series, channels: pd.Series) -> pd.Series:
    """Perceptual hash of decoded images as Spark's image source gives them (rows of BGR or grey bytes)."""
    out = []
    for d, w, h, c in zip(data, width, height, channels):
        if d is None or w < 1 or h < 1:
            out.append(None)
            continue
        px = np.frombuffer(d, dtype=np.uint8).reshape(h, w, c).astype(np.int64)
        grey = px[..., 0] if c == 1 else (px[..., 2] * GREY[0] + px[..., 1] * GREY[1] + px[..., 0] * GREY[2] + 32768) >> 16
        out.append(perceptual_hash(grey))
    return pd.Series(out, dtype=object)
