"""Evaluation texts leaking into training text.

Method: rare n-gram seeds join the passages of the corpus to the test items, then Smith-Waterman alignment scores the
copies, edited ones too, and its score decides. Where a run of consecutive words is asked for, an exact check of the
longest common run follows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from siftwork.llm.surface import words
from siftwork.session import BROADCAST_BYTES, cut

#: Words of a seed; consecutive words that make a leak; windows of so many words have a rare seed each.
NGRAM, RUN = 6, 12
#: An n-gram is a seed if it is at most so many times as frequent as the rarest one of a window it stands in.
EASE = 8
#: Items and bytes of one block, about: the items' n-grams are broadcast block by block, by their counted sizes.
BLOCK, BLOCK_BYTES = 100_000, BROADCAST_BYTES
MATCH, MISMATCH, GAP = 2, -1, -1
#: Words of one passage at least, before it is cut in overlapping ones; words aligned together.
PASSAGE, COLUMNS = 50_000, 40_000

SEEDED = ("doc_id", "item_id", "first", "passage", "grams")


def _codes(ws: list[str], vocab: dict[str, int], n: int) -> np.ndarray:
    """Hash of the n-gram at each position, from the words' own hashes; 0 where one of its words is in no item."""
    ids = np.fromiter((vocab.get(w, 0) for w in ws), dtype=np.uint64, count=len(ws))
    if len(ids) < n:
        return np.zeros(0, dtype=np.int64)
    windows = np.lib.stride_tricks.sliding_window_view(ids, n)
    known = (windows > 0).all(axis=1)
    out = np.zeros(len(windows), dtype=np.int64)
    if known.any():
        h = np.zeros(int(known.sum()), dtype=np.uint64)
        for k in range(n):
            h = (h ^ windows[known, k]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        out[known] = (h | np.uint64(1)).view(np.int64)
    return out


def _vocabulary(variants: list[list[str]]) -> dict[str, int]:
    """Word -> hash of the word itself, so an n-gram has one hash wherever and in whatever order it is met."""
    return {w: xxhash.xxh64_intdigest(w) | 1 for ws in variants for w in ws}


class Index:
    """N-grams of a block of items: sorted hashes, and for each the items it stands in, in two flat arrays."""

    def __init__(self, items: list[tuple[int, str]], n: int) -> None:
        own = [(k, ws) for k, (_, text) in enumerate(items) for ws in words(text)]
        self.ids = [i for i, _ in items]
        self.margin = [n] * len(items)
        for k, ws in own:
            self.margin[k] = max(self.margin[k], len(ws) + n)
        self.vocab = _vocabulary([ws for _, ws in own])
        parts = [(_codes(ws, self.vocab, n), k) for k, ws in own]
        gram = np.concatenate([np.zeros(0, np.int64), *[g for g, _ in parts]])
        item = np.concatenate([np.zeros(0, np.int64), *[np.full(len(g), k) for g, k in parts]])
        order = np.lexsort((item, gram))
        gram, item = gram[order], item[order]
        fresh = np.ones(len(gram), dtype=bool)
        fresh[1:] = (gram[1:] != gram[:-1]) | (item[1:] != item[:-1])
        gram, self.item = gram[fresh], item[fresh]
        self.keys, self.start = np.unique(gram, return_index=True)
        self.start = np.append(self.start, len(gram))

    def hits(self, grams: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """item number -> [(position, hash)] of the n-grams that stand in items."""
        out: dict[int, list[tuple[int, int]]] = {}
        at = np.flatnonzero(grams)
        if not len(at) or not len(self.keys):
            return out
        g = grams[at]
        place = np.minimum(np.searchsorted(self.keys, g), len(self.keys) - 1)
        found = self.keys[place] == g
        for p, h, k in zip(at[found].tolist(), g[found].tolist(), place[found].tolist()):
            for item in self.item[self.start[k] : self.start[k + 1]].tolist():
                out.setdefault(item, []).append((p, h))
        return out


def seed_hits(documents: DataFrame, items: DataFrame, n: int = NGRAM) -> DataFrame:
    """(doc_id, item_id, first, passage, grams): for each document and item that share an n-gram of words, the passages
    around the shared n-grams and their hashes. Every document is read whole, once for each block of items."""
    rows = [(r["item_id"], r["text"]) for r in items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL").toLocalIterator()]
    held = documents.sparkSession.sparkContext.broadcast(rows)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(held.value, n)
        for b in batches:
            out: list[tuple] = []
            for doc, text in zip(b.doc_id, b.text):
                for ws in words(text):
                    for item, own in index.hits(_codes(ws, index.vocab, n)).items():
                        out += [(doc, index.ids[item], *p) for p in _passages(ws, own, index.margin[item], n)]
            yield pd.DataFrame(out, columns=list(SEEDED))

    kinds = f"doc_id {documents.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}"
    return documents.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL").mapInPandas(scan, f"{kinds}, first int, passage string, grams array<bigint>")


def _passages(ws: list[str], hits: list[tuple[int, int]], margin: int, n: int) -> list[tuple[int, str, list[int]]]:
    """Hits less than ``margin`` (the item's words and n) apart make one passage, which reaches ``margin`` words beyond
    them. A long one is cut in parts that overlap by three margins: an alignment with a positive score is never longer."""
    out: list[tuple[int, str, list[int]]] = []
    most, start = max(PASSAGE, 8 * margin), 0
    for k in range(1, len(hits) + 1):
        if k == len(hits) or hits[k][0] - hits[k - 1][0] > margin:
            part = hits[start:k]
            a, b = max(0, part[0][0] - margin), min(len(ws), part[-1][0] + n + margin)
            while a < b:
                z = min(b, a + most)
                own = sorted({h for p, h in part if a <= p and p + n <= z})
                if own:
                    out.append((a, " ".join(ws[a:z]), own))
                if z == b:
                    break
                a = z - 3 * margin
            start = k
    return out


def rare_seeds(hits: DataFrame, items: DataFrame, n: int = NGRAM, run: int = RUN) -> DataFrame:
    """(item_id, seeds): for each window of ``run`` words of each item its n-gram that the fewest documents hold, and those
    of the window at most EASE times as frequent. A document that holds the whole window holds its seeds."""
    count = hits.select("doc_id", F.explode("grams").alias("gram")).distinct().groupBy("gram").agg(F.count("*").alias("df"))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(i, v, p, g) for i, t in zip(b.item_id, b.text) for v, ws in enumerate(words(t)) for p, g in enumerate(_codes(ws, _vocabulary([ws]), n).tolist())]
            yield pd.DataFrame(rows, columns=["item_id", "variant", "pos", "gram"])

    own = items.select("item_id", "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    grams = own.mapInPandas(spread, f"item_id {items.schema['item_id'].dataType.simpleString()}, variant int, pos int, gram bigint").join(count, "gram")
    along = Window.partitionBy("item_id", "variant").orderBy("pos")  # the words of one item
    least = grams.withColumn("least", F.min("df").over(along.rangeBetween(0, run - n)))
    seeds = least.withColumn("most", F.max("least").over(along.rangeBetween(n - run, 0))).where(F.col("df") <= EASE * F.col("most"))
    return seeds.groupBy("item_id").agg(F.collect_set("gram").alias("seeds"))


def align(a: list[str], passages: list[list[str]]) -> list[tuple[int, int, int, int, int]]:
    """For each passage (score, matched words, first, last + 1, longest run) of its best local alignment with item ``a``:
    Smith-Waterman over words, row by row over all passages at once, with what an alignment has matched and where it
    began carried along, so memory is linear. The longest run of equal consecutive words is that of the whole passage.
    first and last are places in the passage."""
    if not a:
        return [(0, 0, 0, 0, 0)] * len(passages)
    code = {w: i for i, w in enumerate(dict.fromkeys(a))}
    heads = np.cumsum([0, *(len(p) + 1 for p in passages)])
    n = int(heads[-1])
    y = np.full(n, -1, dtype=np.int32)  # each passage after a column that matches nothing and lets nothing through
    for h, p in zip(heads, passages):
        y[h + 1 : h + 1 + len(p)] = [code.get(w, -1) for w in p]
    wall = heads[:-1]
    step = np.arange(n, dtype=np.int64) * -GAP
    at = np.arange(n, dtype=np.int64)
    step += (np.cumsum(np.isin(at, wall)) - 1) * (MATCH * len(a) + n + 1)
    score, matched, begin, run = (np.zeros(n, dtype=np.int64) for _ in range(4))
    top, top_matched, top_begin, top_run = (np.zeros(n, dtype=np.int64) for _ in range(4))
    before, row = np.zeros(n, dtype=np.int64), [code[w] for w in a]
    for w in row:
        same = y == w
        before[1:] = run[:-1]
        run = np.where(same, before + 1, 0)
        np.maximum(top_run, run, out=top_run)
        left = np.zeros(n, dtype=np.int64)
        left[1:] = score[:-1]
        diagonal, up = left + np.where(same, MATCH, MISMATCH), score + GAP
        by_diagonal = (diagonal >= up) & (diagonal > 0)
        now = np.maximum(np.maximum(diagonal, up), 0)
        now[wall] = 0
        kept = np.zeros(n, dtype=np.int64)
        kept[1:] = matched[:-1]
        since = at.copy()
        since[1:] = np.where(left[1:] > 0, begin[:-1], at[1:])
        m = np.where(by_diagonal, kept + same, matched)
        s = np.where(by_diagonal, since, begin)
        reach = now + step
        best = np.maximum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach >= best, at, 0))
        score, matched, begin = best - step, m[source], s[source]
        better = score > top
        np.copyto(top, score, where=better)
        np.copyto(top_matched, matched, where=better)
        np.copyto(top_begin, begin, where=better)
    out = []
    for h, z in zip(heads[:-1], heads[1:]):
        j = int(h + top[h:z].argmax())
        out.append((int(top[j]), int(top_matched[j]), int(top_begin[j] - h - 1), int(j - h), int(top_run[h:z].max())) if top[j] > 0 else (0, 0, 0, 0, 0))
    return out


def leaks(documents: DataFrame, items: DataFrame, n: int = NGRAM, run: int = RUN) -> DataFrame:
    """(doc_id, item_id, score, matched, item_words, coverage, longest_run, first_word, last_word): one row per document
    and item of which the document holds a rare n-gram seed, with its best passage.

    ``score`` and ``matched`` are those of the best local alignment, ``coverage`` is matched words over the item's;
    ``longest_run`` is exact where it is at least ``run`` words. Words are runs of letters and digits; letter case,
    accents, punctuation, markup, entities, white space, line ends inside a word, invisible characters and width make no
    difference. Null and empty texts hold nothing; rows with null ids are left out; a repeated document gives one row per
    item. Items are broadcast in blocks of a checked size, each of which reads the corpus once, so any number will do.
    """
    held = items.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(1, -(-held[0] // BLOCK), -(-held[1] // BLOCK_BYTES))
    blocks = [items.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k) for k in range(parts)] if parts > 1 else [items]
    out = None
    for block in blocks:
        found = _leaks(documents, block, n, run)
        out = found if out is None else out.unionByName(found)
    return out


def _leaks(documents: DataFrame, items: DataFrame, n: int, run: int) -> DataFrame:
    hits = cut(seed_hits(documents, items, n), "seed-hits")
    seeds = rare_seeds(hits, items, n, run)
    texts = items.select("item_id", F.col("text").alias("item_text")).where("item_id IS NOT NULL AND text IS NOT NULL")
    texts = F.broadcast(texts.join(seeds, "item_id"))  # a block of items, checked by leaks()
    near = hits.join(texts, "item_id").where(F.arrays_overlap("grams", "seeds"))
    names = ["doc_id", "item_id", "score", "matched", "item_words", "coverage", "longest_run", "first_word", "last_word"]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[int, list[list[str]]] = {}
        for b in batches:
            out: list[tuple] = []
            for item, part in b.groupby("item_id", sort=False):
                own = known.setdefault(item, words(part.item_text.iloc[0]))
                docs, firsts, passages = part.doc_id.tolist(), part["first"].tolist(), [p.split(" ") for p in part.passage]
                for low, high in _runs([len(p) for p in passages]):
                    for a in own:
                        for doc, first, (s, m, x, z, r) in zip(docs[low:high], firsts[low:high], align(a, passages[low:high])):
                            out.append((doc, item, s, m, len(a), m / max(1, len(a)), r, first + x, first + z))
            yield pd.DataFrame(out, columns=names)

    kinds = ", ".join(f"{c} {hits.schema[c].dataType.simpleString()}" for c in ("doc_id", "item_id"))
    scored = near.select("doc_id", "item_id", "first", "passage", "item_text").mapInPandas(score, f"{kinds}, score int, matched int, item_words int, coverage double, longest_run int, first_word int, last_word int")
    rest = F.max_by(F.struct("score", "matched", "item_words", "coverage", "first_word", "last_word"), F.struct("score", "matched", F.negative("first_word"), F.negative("last_word"))).alias("b")
    return scored.groupBy("doc_id", "item_id").agg(rest, F.max("longest_run").alias("longest_run")).select("doc_id", "item_id", "b.score", "b.matched", "b.item_words", "b.coverage", "longest_run", "b.first_word", "b.last_word")


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of passages with about COLUMNS words in all."""
    low, total = 0, 0
    for k, size in enumerate(sizes):
        if total and total + size > COLUMNS:
            yield low, k
            low, total = k, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


def leaked_pairs(documents: DataFrame, items: DataFrame, run: int = RUN) -> DataFrame:
    """(doc_id, item_id): the document holds at least ``run`` consecutive words of the item. Such a run alone scores
    ``run`` matches, so pairs whose alignment scores less are none; the exact check of the run follows."""
    return leaks(documents, items, run=run).where(F.col("score") >= MATCH * run).where(F.col("longest_run") >= run).select("doc_id", "item_id")


def edited_copies(documents: DataFrame, items: DataFrame, coverage: float = 0.5, least_words: int = RUN) -> DataFrame:
    """The rows of :func:`leaks` in which the alignment covers at least that part of the item and as many words, whether
    or not a long run is left unedited."""
    return leaks(documents, items).where((F.col("coverage") >= coverage) & (F.col("matched") >= least_words))


def leaked_items(documents: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, suite, documents, best_coverage): the items that leak, in how many documents and how far."""
    per = leaks(documents, items).where(F.col("longest_run") >= RUN).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("coverage").alias("best_coverage"))
    return per.join(items.select("item_id", "suite").distinct(), "item_id").select("item_id", "suite", "documents", "best_coverage")
