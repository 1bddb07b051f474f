import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from siftwork.llm import chunks, mixing, tokens

DOCS = "doc_id long, text string, source string, block int, n_tokens int"
TARGETS = "mix_id long, mix_name string, source string, target_share double, max_repeats long, budget_tokens long, available int"
PATH = tokens.vocabulary_path()


def docs(seed=3, n=80):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice(["alpha", "beta", "été", "x."]) for _ in range(r.randrange(0, 400))), r.choice(["a", "A ", "b", "c", None]), 0, 0) for i in range(n)]
    return rows + [(n, None, "a", 0, 0), (n + 1, "", "b", 0, 0)]


def sizes(rows):
    n = defaultdict(int)
    for _, t, s, *_ in rows:
        n[(s or "").strip().lower()] += tokens.count(t, PATH)
    return n


def targets(have):
    return [(1, "m", "A", 0.5, 2, 9000, 0), (2, "m", "b", 0.3, 1, 9000, 0), (3, "m", "c", 0.1, None, 9000, 0), (4, "m", "nobody", 0.1, 3, 9000, 0), (5, "k", "b", 1.0, 3, have["b"] * 2 + 77, 0)]


def test_mix_shares_repeats_and_shortfalls(spark):
    rows = docs()
    have = sizes(rows)
    want = targets(have)
    plan, mix = mixing.draw_mix(spark.createDataFrame(rows, DOCS), spark.createDataFrame(want, TARGETS), block=128)
    got = mix.collect()
    used, uses = defaultdict(int), Counter()
    for r in got:
        used[r.mix_id] += r.last_token - r.first_token
        for t in range(r.first_token, r.last_token):
            uses[r.mix_id, r.doc_id, t] += 1
    text = {i: (t, (s or "").strip().lower()) for i, t, s, *_ in rows}
    for i, _, s, share, rep, budget, _ in want:
        assert used[i] == min(math.ceil(share * budget), have[s.strip().lower()] * (rep or 1))
    cap = {i: rep or 1 for i, _, _, _, rep, *_ in want}
    assert all(n <= cap[i] for (i, _, _), n in uses.items())
    assert all(r.source == text[r.doc_id][1] and r.last_token <= tokens.count(text[r.doc_id][0], PATH) for r in got)
    found = {r.mix_id for r in mixing.unreachable(spark.createDataFrame(rows, DOCS), spark.createDataFrame(want, TARGETS)).collect()}
    assert found == {i for i, _, s, share, rep, budget, _ in want if have[s.strip().lower()] * (rep or 1) < share * budget}
    assert {r.mix_id for r in plan.where("NOT reached").collect()} == found
    again = mixing.draw_mix(spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(want, TARGETS), block=128)[1]
    assert sorted(again.collect()) == sorted(got)


def test_bucket_count_changes_nothing(spark, monkeypatch):
    rows = docs()
    d, t = spark.createDataFrame(rows, DOCS), spark.createDataFrame(targets(sizes(rows)), TARGETS)
    before = sorted(mixing.draw_mix(d, t, block=128)[1].collect())
    monkeypatch.setattr(mixing, "BUCKETS", 2)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 3)
    assert sorted(mixing.draw_mix(d, t, block=128)[1].collect()) == before


def test_slots_are_whole_blocks(spark):
    rows = docs()
    mix = mixing.draw_mix(spark.createDataFrame(rows, DOCS), spark.createDataFrame(targets(sizes(rows)), TARGETS), block=128)[1]
    slots = defaultdict(list)
    for r in mix.collect():
        slots[r.mix_id, r.slot].append((r.at, r.at + r.last_token - r.first_token))
    for spans in slots.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and spans[-1][1] <= 128


def test_empty_mix(spark):
    d = spark.createDataFrame(docs(), DOCS)
    t = spark.createDataFrame(targets(sizes(docs())), TARGETS)
    assert mixing.draw_mix(d.where("false"), t)[1].count() == 0
    assert mixing.draw_mix(d, t.where("false"))[1].count() == 0
    assert mixing.unreachable(d.where("false"), t).count() == 5


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000])
def test_permutation(n):
    for key in (0, -5, 2**62):
        got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, key))
        assert sorted(got.tolist()) == list(range(n))


def text(seed, kind):
    r = random.Random(seed)
    if kind == "prose":
        return "".join(r.choice(["word ", "été ", "End. ", "line\n", "para\n\n", "x"]) for _ in range(4000))
    if kind == "solid":
        return "".join(r.choice("abcdefghij") for _ in range(9000))
    if kind == "wide":
        return "".join(r.choice("漢字かな𝔘😀é") for _ in range(3000))
    return " " * 5000 + "a" + "\n" * 3000


@pytest.mark.parametrize("kind", ["prose", "solid", "wide", "blank"])
def test_pieces(spark, kind):
    rows = [(s, text(s, kind), "a", 0, 0) for s in range(3)] + [(8, None, "a", 0, 0), (9, "short", "a", 0, 0), (None, text(1, kind), "a", 0, 0)]
    out = defaultdict(list)
    for r in chunks.split_oversized(spark.createDataFrame(rows, DOCS)).collect():
        out[r.doc_id].append(r)
    assert set(out) == {i for i, t, *_ in rows if i is not None and tokens.count(t, PATH) > 1000}
    for i, pieces in out.items():
        pieces.sort(key=lambda r: r.piece)
        full = dict((r[0], r[1]) for r in rows)[i]
        assert pieces[0].first_token == 0 and pieces[-1].last_token == pieces[0].n_tokens == tokens.count(full, PATH)
        assert pieces[0].first_char == 0 and pieces[-1].last_char == len(full)
        for a, b in zip(pieces, pieces[1:]):
            assert a.last_token - b.first_token == 64
        for p in pieces:
            assert p.text == full[p.first_char : p.last_char] and p.last_token - p.first_token <= 1000
            if p.cut in ("paragraph", "line", "sentence", "word"):
                assert full[p.last_char - 1].isspace() or full[p.last_char].isspace()


def test_cuts_are_the_cheapest_of_all(monkeypatch):
    r = np.random.default_rng(5)
    for _ in range(40):
        n = int(r.integers(21, 60))
        kind = r.choice([0, 1, 2, 3, 4], n, p=[0.1, 0.1, 0.2, 0.4, 0.2])
        pieces = -(-(n - 4) // 16)
        got = chunks._solve(kind, n, pieces, 20, 4)

        def cost(ends):
            c, before = 0.0, 4
            ideal = (n - 4) / pieces + 4
            for k, e in enumerate(ends):
                size = e - before + 4
                if size > 20 or size <= 4:
                    return np.inf
                c += chunks.BALANCE * (size / ideal - 1) ** 2
                if k < len(ends) - 1:
                    if kind[e - 1] >= 4:
                        return np.inf
                    c += chunks.PENALTY[kind[e - 1]] + (chunks.RAGGED if kind[max(e - 5, 0)] >= 4 else 0)
                before = e
            return c

        import itertools

        best = min((cost([*x, n]) for x in itertools.combinations(range(5, n), pieces - 1)), default=np.inf)
        assert (got is None and best == np.inf) or abs(got[0] - best) < 1e-6


def test_blockwise_search_equals_plain():
    r = np.random.default_rng(1)
    for _ in range(20):
        ends = np.unique(r.integers(0, 1500, 700))
        span = np.unique(r.integers(500, 2400, 700))
        cost = r.random(len(ends)) * 5
        back, low, high = chunks._best_before(ends, cost, span, 900.0, 1000, 64)
        for j, e in enumerate(span):
            if low[j] < high[j]:
                x = cost[low[j] : high[j]] + chunks.BALANCE * ((e - ends[low[j] : high[j]] + 64) / 900 - 1) ** 2
                assert abs(x[back[j] - low[j]] - x.min()) < 1e-9


def test_stretches_give_the_same_tokens(monkeypatch):
    t = text(4, "prose") + text(4, "wide") + " tail end"
    want = tokens.count(t, PATH)
    ends = tokens.ends(t, PATH)[1]
    monkeypatch.setattr(tokens, "STRETCH", 50)
    assert tokens.count(t, PATH) == want and (tokens.ends(t, PATH)[1] == ends).all()
    assert tokens.count("\ud800x", PATH) > 0


def test_no_pieces_of_an_empty_table_and_bad_overlap(spark):
    d = spark.createDataFrame(docs(), DOCS)
    assert chunks.split_oversized(d.where("false")).count() == 0
    with pytest.raises(ValueError):
        chunks.split_oversized(d, 10, 10)


def test_words_are_cut_only_where_no_boundary_is_in_reach():
    kind = np.full(6000, 4)
    kind[599::600] = 3
    assert chunks.plan_cuts(kind) == [*range(600, 6001, 600)]
    kind = np.full(30_000, 4)
    kind[99::100] = 3
    kind[899::900] = 0
    kind[12_000:13_500] = 4
    kind[13_499] = 3
    cuts = chunks.plan_cuts(kind)
    first, inside = 64, []
    for end in cuts[:-1]:
        assert end - first <= 936
        if kind[end - 1] == 4:
            inside.append(end)
            assert not (kind[first : first + 936] < 4).any()
        first = end
    assert cuts[-1] == 30_000 and 30_000 - first <= 936
    assert len(inside) == 1 and sum(kind[e - 1] == 0 for e in cuts[:-1]) > 0.8 * len(cuts)
