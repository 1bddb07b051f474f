"""Splitting oversized texts at natural boundaries.

Method: dynamic programming over boundary positions. The number of pieces is the least possible, or one more where that
avoids cuts at mere word ends; among all ways to cut that many, the one with the least sum of cut penalties and size
imbalance is taken. A character is at most four tokens, so a cut between characters is always in reach if limit minus
overlap is four tokens or more; below that, a text may have to be cut by count. Where so few pieces can't all end at natural boundaries, each piece has its price in that sum instead,
and a word is cut only where no boundary is in reach.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwork.llm import tokens

MAX_TOKENS, OVERLAP = 1000, 64
#: Penalty of a cut at a paragraph, line, sentence, word end, and inside a word.
PENALTY = np.array([0.0, 1.0, 2.0, 5.0, 60.0])
KINDS = ("paragraph", "line", "sentence", "word", "inside")
#: Penalty of a piece that begins inside a word, and weight of the squared relative imbalance.
RAGGED, BALANCE = 3.0, 4.0

_NEWLINES = np.array([0x0A, 0x0B, 0x0C, 0x0D, 0x85, 0x2028, 0x2029], dtype=np.uint32)
_SPACES = np.array([0x09, 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000, 0x1C, 0x1D, 0x1E, 0x1F], dtype=np.uint32)
_STOPS = np.array([ord(c) for c in ".!?…。！？:;"], dtype=np.uint32)
_CLOSERS = np.array([ord(c) for c in "\"'”’)]}»"], dtype=np.uint32)


def boundaries(text: str, end: np.ndarray) -> np.ndarray:
    """Kind of boundary (index into KINDS) after each token, by the run of white space that touches its end; 9 where no
    cut is possible, inside a character."""
    c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    n = len(c)
    line = np.isin(c, _NEWLINES)
    space = line | np.isin(c, _SPACES)
    # runs of white space: number, and for each run whether it has one line end or an empty line
    new = space & ~np.concatenate([[False], space[:-1]])
    run = np.where(space, np.cumsum(new), 0)
    lines = np.bincount(run[line], minlength=int(run.max(initial=0)) + 1)
    crlf = np.zeros(n, dtype=bool)
    crlf[1:] = (c[1:] == 0x0A) & (c[:-1] == 0x0D)
    lines = lines - np.bincount(run[crlf], minlength=len(lines))
    first = np.flatnonzero(new)
    before = first - 1  # the last character before each run, closing quotes and brackets skipped
    for _ in range(3):
        closer = (before > 0) & np.isin(c[np.maximum(before, 0)], _CLOSERS)
        before = before - closer
    stop = np.concatenate([[False], (before >= 0) & np.isin(c[np.maximum(before, 0)], _STOPS[:7])]) if len(first) else np.zeros(1, dtype=bool)
    kind_of = np.where(lines > 1, 0, np.where(lines == 1, 1, np.where(stop[: len(lines)], 2, 3)))
    at = np.clip(end, 0, n)
    left, right = run[np.maximum(at - 1, 0)], np.where(at < n, run[np.minimum(at, n - 1)], 0)
    touching = np.where(right > 0, right, np.where(at > 0, left, 0))
    kind = np.where(touching > 0, kind_of[touching], 4)
    return np.where(end < 0, 9, kind).astype(np.int64)


def plan_cuts(kind: np.ndarray, limit: int = MAX_TOKENS, overlap: int = OVERLAP) -> list[int]:
    """Ends of the pieces, in tokens; piece k runs from ``overlap`` tokens before the end of piece k-1. ``kind`` is the
    boundary after each token. The last end is the number of tokens."""
    n = len(kind)
    if n <= limit:
        return [n]
    fresh = limit - overlap
    least = -(-(n - overlap) // fresh)
    best = _solve(kind, n, least, limit, overlap) or _solve(kind, n, least + 1, limit, overlap)
    if best is None:  # the natural boundaries are too far apart for so few pieces
        best = _priced(kind, n, least, limit, overlap) or _solve(kind, n, least, limit, overlap, 9)
    if best is not None and best[2] >= 3:  # one more piece, if all its cuts then fall at sentence ends or better
        more = _solve(kind, n, least + 1, limit, overlap, 3)
        if more is not None and more[0] + PENALTY[3] < best[0]:
            best = more
    if best is None:  # limit - overlap is below four tokens and no cut keeps characters whole: cut by count
        return [*range(limit, n, fresh), n] if n > limit else [n]
    return best[1]


def _best_before(ends: np.ndarray, cost: np.ndarray, span: np.ndarray, ideal: float, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each end in ``span`` the best of the ends before it, and the range of those within the limit. The squared
    imbalance of a piece is (a - b)^2 with a of its end and b of the end before; as it is convex and the ranges move
    with the end, the best end before never moves back, so every 32nd is sought first and the others between them."""
    a, b = (span + overlap) / ideal - 1, ends / ideal
    fixed = cost + BALANCE * b * b
    low, high = np.searchsorted(ends, span + overlap - limit, "left"), np.searchsorted(ends, span, "left")
    back = np.zeros(len(span), dtype=np.int64)

    def fill(js: np.ndarray, first: int, last: int) -> None:
        rows = np.arange(first, last)[:, None]
        step = fixed[first:last, None] - (2 * BALANCE) * b[first:last, None] * a[js]
        step[(rows < low[js]) | (rows >= high[js])] = np.inf
        back[js] = first + step.argmin(axis=0)

    if len(ends) * len(span) <= 40_000:
        fill(np.arange(len(span)), 0, len(ends))
        return back, low, high
    open_ = np.flatnonzero(low < high)
    if not len(open_):
        return back, low, high
    marks = np.unique(np.append(np.arange(0, len(open_), 32), len(open_) - 1))
    fill(open_[marks], 0, len(ends))
    for x, y in zip(marks[:-1], marks[1:]):
        if y - x > 1:
            fill(open_[x + 1 : y], int(back[open_[x]]), int(back[open_[y]]) + 1)
    return back, low, high


def _solve(kind: np.ndarray, n: int, pieces: int, limit: int, overlap: int, below: int = 4) -> tuple[float, list[int], int] | None:
    """(cost, ends, worst kind of cut) of the cheapest way to cut into so many pieces."""
    fresh, ideal = limit - overlap, (n - overlap) / pieces + overlap
    layers: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    ends, cost = np.array([overlap]), np.array([0.0])  # a piece begins ``overlap`` before the end of the last one; the first at 0
    for k in range(1, pieces):
        low = max(n - (pieces - k) * fresh, overlap + 1)
        high = min(k * fresh + overlap, n - 1)
        if low > high:
            return None
        span = np.arange(low, high + 1)
        kinds = kind[span - 1]
        able = kinds < below
        if not able.any():
            return None
        span, kinds = span[able], kinds[able]
        start_kind = kind[np.maximum(span - overlap - 1, 0)] if overlap else kinds
        own = PENALTY[kinds] + np.where(start_kind >= 4, RAGGED, 0.0)
        own = own + np.where(start_kind == 9, 10 * PENALTY[4], 0.0)
        back, low_i, high_i = _best_before(ends, cost, span, ideal, limit, overlap)
        before = ends[back]
        reached = np.where(low_i < high_i, cost[back] + BALANCE * ((span - before + overlap) / ideal - 1) ** 2, np.inf) + own
        good = np.isfinite(reached)
        if not good.any():
            return None
        span, back, reached = span[good], back[good], reached[good]
        layers.append((span, back, kind[span - 1]))
        ends, cost = span, reached
    size = n - ends + overlap
    last = np.where((size <= limit) & (size > overlap), cost + BALANCE * (size / ideal - 1) ** 2, np.inf)
    at = int(last.argmin())
    if not np.isfinite(last[at]):
        return None
    total, out, worst = float(last[at]), [n], 0
    for span, back, kinds in reversed(layers):
        out.append(int(span[at]))
        worst = max(worst, int(kinds[at]))
        at = int(back[at])
    return total, out[::-1], worst


def _priced(kind: np.ndarray, n: int, least: int, limit: int, overlap: int) -> tuple[float, list[int], int] | None:
    """As :func:`_solve`, with any number of pieces, each at the price of a cut at a word end. A cut falls inside a word
    only if no boundary is within the limit, and never inside a character."""
    fresh, ideal = limit - overlap, (n - overlap) / least + overlap
    start_kind = kind[np.maximum(np.arange(1, n + 1) - overlap - 1, 0)] if overlap else kind
    own = PENALTY[np.minimum(kind, 4)] + np.where(start_kind >= 4, RAGGED, 0.0) + np.where(start_kind == 9, 10 * PENALTY[4], 0.0) + PENALTY[3]
    own[n - 1] = 0.0
    last = np.arange(n) == n - 1
    natural, whole = np.where((kind < 4) | last, own, np.inf), np.where((kind < 9) | last, own, np.inf)
    ends = np.flatnonzero(np.isfinite(natural)) + 1
    within = (ends[np.searchsorted(ends, np.arange(n), "right")] - np.arange(n) <= fresh).tolist()
    balance = BALANCE * ((np.arange(1, fresh + 1) + overlap) / ideal - 1) ** 2
    cost, back = np.full(n + 1, np.inf), np.full(n + 1, -1, dtype=np.int64)
    cost[overlap] = 0.0
    for at in range(overlap, n):
        if (so_far := cost[at]) == np.inf:
            continue
        high = min(at + fresh, n)
        total = (natural if within[at] else whole)[at:high] + balance[: high - at]
        total += so_far
        known = cost[at + 1 : high + 1]
        better = total < known
        np.copyto(known, total, where=better)
        back[at + 1 : high + 1][better] = at
    if not np.isfinite(cost[n]):
        return None
    out = [n]
    while back[out[-1]] > overlap:
        out.append(int(back[out[-1]]))
    return float(cost[n]), out[::-1], max(int(kind[e - 1]) for e in out[1:])


def split_oversized(documents: DataFrame, limit: int = MAX_TOKENS, overlap: int = OVERLAP, path: str | None = None, with_text: bool = True) -> DataFrame:
    """(doc_id, n_tokens, piece, first_token, last_token, first_char, last_char, cut, text): the pieces of each text over
    ``limit`` tokens, at most ``limit`` tokens each; consecutive pieces share exactly ``overlap`` tokens. ``cut`` is the
    kind of boundary at the piece's end, ``end`` for the last one. Places are half-open.

    A cut falls at a paragraph, line, sentence or word end wherever a window has one; a longer word is cut between
    tokens, never inside a character. Texts that are null, empty or within the limit give no rows, which a text of no
    more bytes than ``limit`` is known to be without counting. Rows with a null id are left out; a repeated row gives its
    pieces once. Texts of any length are split whole.
    """
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")
    where = path or tokens.vocabulary_path()
    names = ["doc_id", "n_tokens", "piece", "first_token", "last_token", "first_char", "last_char", "cut", "text"]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            for doc, raw in zip(b.doc_id, b.text):
                text, end = tokens.ends(raw, where)
                n = len(end)
                if n <= limit:
                    continue
                kind = boundaries(text, end)
                first = 0
                cuts = plan_cuts(kind, limit, overlap)
                for k, last in enumerate(cuts):
                    a, z = int(end[first - 1]) if first else 0, int(end[last - 1])
                    if a < 0:  # the shared tokens begin inside a character: show it whole
                        a = int(end[:first][end[:first] >= 0][-1]) if (end[:first] >= 0).any() else 0
                    if z < 0:
                        z = int(end[last:][end[last:] >= 0][0])
                    out.append((doc, n, k, first, last, a, z, "end" if k == len(cuts) - 1 else KINDS[min(4, kind[last - 1])], text[a:z] if with_text else None))
                    first = last - overlap
                if len(out) > 5000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            yield pd.DataFrame(out, columns=names)

    long = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull() & (F.octet_length("text") > limit))
    kind = documents.schema["doc_id"].dataType.simpleString()
    return long.mapInPandas(split, f"doc_id {kind}, n_tokens bigint, piece int, first_token bigint, last_token bigint, first_char bigint, last_char bigint, cut string, text string")


def oversized(documents: DataFrame, limit: int = MAX_TOKENS, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id): each document that had to be split."""
    return split_oversized(documents, limit, overlap, with_text=False).where("piece = 0").select("doc_id").distinct()
