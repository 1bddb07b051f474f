import random

import pytest

from siftwork.llm import leakage as L
from siftwork.llm.surface import words

DOCS = "doc_id long, text string, item_id long, passage string"
ITEMS = "item_id long, suite string, text string, doc_id int"


@pytest.mark.parametrize(
    "a, b",
    [
        ("Caf&eacute; au lait", "cafe AU lait"),
        ("work<b>sh</b>op", "workshop"),
        ("line<br/>end", "line end"),
        ("Zhonl-\r\nagrav", "zhonlagrav"),
        ("soft­\nly", "softly"),
        ("in​vis⁠ible", "invisible"),
        ("Ｆｕｌｌ　ｗｉｄｔｈ１", "full width1"),
        ("Straße éte", "strasse été"),
        ("&amp;eacute;t&#233;", "été"),
        ("<p>a</p>b <!-- c --> d < e > f", "a b d e f"),
        ("x_y", "x y"),
    ],
)
def test_surface(a, b):
    assert words(a)[0] == words(b)[0]


def corpus(seed=6):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)] + ["the", "of", "and"] * 20
    text = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, "s", " ".join(text(r.randrange(0, 60))), 0) for i in range(25)]
    docs = []
    for d in range(120):
        ws = text(r.randrange(0, 200))
        for _ in range(r.randrange(3)):
            src = r.choice(items)[2].split()
            if src:
                a = r.randrange(len(src))
                at = r.randrange(len(ws) + 1)
                ws[at:at] = src[a : a + r.randrange(1, 40)]
        docs.append((d, r.choice([" ", " ", "\n"]).join(ws).upper(), 1, "x"))
    return items, docs + [(500, None, 1, ""), (501, "", 1, ""), (None, docs[0][1], 1, "")]


def brute(items, docs, run=12):
    out = set()
    for i, _, t, _ in items:
        own = {tuple(ws[k : k + run]) for ws in words(t) for k in range(len(ws) - run + 1)}
        for d, x, *_ in docs:
            if d is not None and any(tuple(ws[k : k + run]) in own for ws in words(x) for k in range(len(ws) - run + 1)):
                out.add((d, i))
    return out


def test_leaks_equal_brute_force(spark):
    for seed in (6, 7):
        items, docs = corpus(seed)
        want = brute(items, docs)
        assert want
        got = [tuple(r) for r in L.leaked_pairs(spark.createDataFrame(docs + docs[:5], DOCS), spark.createDataFrame(items, ITEMS)).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_blocks_of_items(spark, monkeypatch):
    items, docs = corpus(8)
    monkeypatch.setattr(L, "BLOCK", 10)
    got = {tuple(r) for r in L.leaked_pairs(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == brute(items, docs)


def test_edited_copy_scores_high(spark):
    item = " ".join(f"w{i}" for i in range(40))
    edited = [f"w{i}" for i in range(40)]
    edited[9], edited[19], edited[30] = "x", "y", "z"
    r = L.leaks(spark.createDataFrame([(1, "a b " + " ".join(edited) + " c", 0, "")], DOCS), spark.createDataFrame([(1, "s", item, 0)], ITEMS)).first()
    assert (r.matched, r.longest_run, r.first_word, r.last_word) == (37, 10, 2, 42) and r.coverage > 0.9


def test_recall_of_edited_copies(spark):
    r = random.Random(9)
    vocab = [f"w{i}" for i in range(2000)] + ["the", "of", "and", "in"] * 100
    items = [(i, "s", " ".join(r.choice(vocab) for _ in range(r.randrange(40, 120))), 0) for i in range(40)]
    docs, want = [], set()
    for d in range(300):
        ws = [r.choice(vocab) for _ in range(r.randrange(50, 200))]
        if d % 2:
            i, _, text, _ = r.choice(items)
            copy = []
            for w in text.split():
                x = r.random()  # one word in ten is replaced, left out or has another before it
                copy += [r.choice(vocab)] if x < 0.05 else [] if x < 0.075 else [r.choice(vocab), w] if x < 0.1 else [w]
            ws[20:20] = copy
            want.add((d, i))
        docs.append((d, " ".join(ws), 1, ""))
    got = {(x.doc_id, x.item_id) for x in L.edited_copies(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert len(got & want) >= 0.95 * len(want) and got <= want


def test_hashes_do_not_depend_on_the_order_of_items():
    items, _ = corpus()
    pairs = [(i, t) for i, _, t, _ in items]
    a, b = L.Index(pairs, 6), L.Index(pairs[::-1], 6)
    assert a.vocab == b.vocab and (a.keys == b.keys).all()


def test_long_passages_are_cut_without_loss(spark, monkeypatch):
    items, docs = corpus(11)
    monkeypatch.setattr(L, "PASSAGE", 1)
    monkeypatch.setattr(L, "COLUMNS", 50)
    got = {tuple(r) for r in L.leaked_pairs(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)).collect()}
    assert got == brute(items, docs)


def test_item_in_a_repetitive_document(spark):
    item = " ".join(f"r{i % 3}" for i in range(300))
    text = " ".join(f"r{i % 3}" for i in range(300_000))
    r = L.leaks(spark.createDataFrame([(1, text, 0, "")], DOCS), spark.createDataFrame([(3, "s", item, 0)], ITEMS)).first()
    assert (r.longest_run, r.coverage) == (300, 1.0)


def test_alignment_by_plain_dynamic_programming():
    r = random.Random(1)
    cases = []
    for _ in range(80):
        a, b = [r.choice("abcd") for _ in range(r.randrange(9))], [r.choice("abcd") for _ in range(r.randrange(12))]
        best, run, h, c = 0, 0, {}, {}
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                c[i, j] = c.get((i - 1, j - 1), 0) + 1 if x == y else 0
                run = max(run, c[i, j])
                h[i, j] = max(0, h.get((i - 1, j - 1), 0) + (2 if x == y else -1), h.get((i - 1, j), 0) - 1, h.get((i, j - 1), 0) - 1)
                best = max(best, h[i, j])
        cases.append((a, b, best, run))
    for a in {tuple(c[0]) for c in cases}:
        same = [c for c in cases if tuple(c[0]) == a] + cases[:5]
        got = L.align(list(a), [b for _, b, *_ in same])
        for (x, b, best, run), (score, matched, first, last, longest) in zip(same, got):
            if tuple(x) == a:
                assert (score, longest) == (best, run) and matched <= last - first and 2 * matched >= score


def test_empty_tables(spark):
    items, docs = corpus()
    d, i = spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)
    assert L.leaked_pairs(d.where("false"), i).count() == 0 and L.leaked_pairs(d, i.where("false")).count() == 0


def test_very_long_text(spark):
    item = " ".join(f"q{i}" for i in range(30))
    text = "word " * 400_000 + item + " word" * 100_000
    assert L.leaked_pairs(spark.createDataFrame([(1, text, 0, "")], DOCS), spark.createDataFrame([(3, "s", item, 0)], ITEMS)).count() == 1
