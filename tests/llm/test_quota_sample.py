import math
import random
from collections import Counter

import numpy as np
import pytest

from siftwork.llm import quota_sample as Q

SHAPE = "image_id long, category_code string, institution string, unit_code string, bucket int, quota long"
TARGETS = "target_id long, plan_name string, field_name string, category string, target_share double, min_rows long, sample_rows long"


def data(spark, n=600, seed=1):
    r = random.Random(seed)
    rows = [(i, r.choice(["a", "a", "a", "A ", "b", "c", None]), r.choice(["i", "j", " J"]), r.choice(["u", None]), 9, 9) for i in range(n)]
    return spark.createDataFrame(rows + rows[:20], SHAPE), rows


def test_draw_meets_targets_and_floors(spark):
    df, rows = data(spark)
    plan = [(1, "p", "category_code", "A", 0.5, 2, 100), (2, "p", "category_code", "b", 0.3, None, 100), (3, "p", "category_code", "c", 0.15, 20, 100), (4, "p", "category_code", "zzz", 0.05, None, 100)]
    report, sample = Q.draw(df, spark.createDataFrame(plan, TARGETS))
    got = {r.target_id: r for r in report.collect()}
    drawn = sample.collect()
    assert len({r.image_id for r in drawn}) == len(drawn)
    true = {i: (c or "").strip().lower() for i, c, *_ in rows}
    assert all(true[r.image_id] == r.category for r in drawn)
    assert Counter(r.category for r in drawn) == {"a": 50, "b": 30, "c": 20}
    assert [got[i].drawn for i in (1, 2, 3, 4)] == [50, 30, 20, 0]
    assert [got[i].met for i in (1, 2, 3, 4)] == [True, True, True, False] and got[4].shortfall == 5
    again = Q.draw(df.repartition(7), spark.createDataFrame(plan, TARGETS))[1].collect()
    assert sorted(again) == sorted(drawn)


def test_secondary_margin_is_kept(spark):
    df, rows = data(spark, 4000)
    plan = [(1, "p", "category_code", "a", 1.0, None, 1000)]
    sample = {r.image_id for r in Q.draw(df, spark.createDataFrame(plan, TARGETS))[1].collect()}
    own = [(i, x.strip().lower()) for i, c, x, *_ in rows if c and c.strip().lower() == "a"]
    share = sum(x == "i" for _, x in own) / len(own)
    assert abs(sum(x == "i" for i, x in own if i in sample) / 1000 - share) < 0.01


def test_unmet_equals_counting(spark):
    df, rows = data(spark)
    r = random.Random(3)
    n = Counter((c or "").strip().lower() for _, c, *_ in rows)
    plan = [(i, f"p{i % 3}", "category_code", r.choice(["a", "b", "c"]), r.random(), r.choice([None, 0, 90, 400]), r.choice([0, 100, 700])) for i in range(40)]
    want = {i for i, _, _, c, s, m, k in plan if n[c] < max(m or 0, s * k)}
    assert {x.target_id for x in Q.unmet(df, spark.createDataFrame(plan, TARGETS)).collect()} == want


def test_empty_tables_and_bad_field(spark):
    df, _ = data(spark)
    none = spark.createDataFrame([], TARGETS)
    assert Q.draw(df, none)[0].count() == Q.draw(df, none)[1].count() == 0
    one = spark.createDataFrame([(1, "p", "category_code", "a", 1.0, None, 10), (2, "p", "category_code", "b", 0.0, None, 10)], TARGETS)
    assert [r.target_id for r in Q.unmet(df.where("false"), one).collect()] == [1]
    assert Q.draw(df.where("false"), one)[1].count() == 0
    with pytest.raises(ValueError):
        Q.draw(df, spark.createDataFrame([(1, "p", "title", "a", 1.0, None, 10)], TARGETS))


def test_blocks_of_cells_keep_needs_and_quotas(spark, monkeypatch):
    df, rows = data(spark)
    plan = spark.createDataFrame([(1, "p", "category_code", "a", 0.5, None, 40), (2, "p", "category_code", "b", 0.45, 3, 40), (3, "p", "category_code", "zzz", 0.05, 7, 40), (4, "q", "institution", "i", 1.0, None, 5000)], TARGETS)
    whole = sorted(Q.draw(df, plan)[0].collect())
    for size in (1, 2, 3):
        monkeypatch.setattr(Q, "BLOCK_CELLS", size)
        report, sample = Q.draw(df, plan)
        assert sorted(report.collect()) == whole
        drawn = sample.collect()
        assert len(set(drawn)) == len(drawn) and Counter(r.category for r in drawn if r.plan_name == "p") == {"a": 20, "b": 18}
    assert [r.shortfall for r in whole][:3] == [0, 0, 7] and whole[3].shortfall == 5000 - whole[3].available


def test_drawn_cells_keep_both_margins_and_their_odds():
    r = random.Random(5)
    rows = []
    for _ in range(7):
        cells = [(m, r.randint(1, 30)) for m in "abcdefgh" if r.random() < 0.7] or [("a", 3)]
        have = sum(n for _, n in cells)
        rows.append((r.randint(0, have), have, cells))
    mean = [[0.0] * len(c) for *_, c in rows]
    runs = 600
    for seed in range(runs):
        got = Q.draw_cells(rows, np.random.default_rng(seed))
        columns, want = Counter(), Counter()
        for (take, have, cells), q, m in zip(rows, got, mean):
            assert sum(q) == take
            for j, ((name, n), x) in enumerate(zip(cells, q)):
                share = take * n / have
                assert math.floor(share) <= x <= math.ceil(share)
                columns[name] += x
                want[name] += share
                m[j] += x / runs
        assert all(math.floor(want[c] - 1e-9) <= columns[c] <= math.ceil(want[c] + 1e-9) for c in columns)
    for (take, have, cells), m in zip(rows, mean):
        assert all(abs(x - take * n / have) < 0.09 for (_, n), x in zip(cells, m))


def test_large_network_is_solved():
    r = random.Random(2)
    pieces = []
    for _ in range(500):
        cells = [(f"m{j}", r.randint(1, 1000)) for j in range(100)]
        have = sum(n for _, n in cells)
        pieces.append(Q.Piece(have + 5 if r.random() < 0.1 else have // 3, 10, have // 3, have, cells))
    short, quota = Q.solve_block(pieces, np.random.default_rng(1))
    assert [s > 0 for s in short] == [p.demand > p.have for p in pieces]
    assert all(sum(q) == p.take and all(x <= n for (_, n), x in zip(p.cells, q)) for p, q in zip(pieces, quota))


def test_one_category_in_two_targets(spark):
    df, _ = data(spark)
    plan = [(1, "p", "category_code", "a", 0.5, None, 20), (2, "p", "category_code", "A ", 0.25, None, 20)]
    drawn = Q.draw(df, spark.createDataFrame(plan, TARGETS))[1].collect()
    assert len({x.image_id for x in drawn}) == len(drawn) >= 10


def test_flow_is_cheapest():
    for seed in range(30):
        r = random.Random(seed)
        arcs = [(0, 1, r.randint(0, 5), r.randint(0, 4)), (0, 2, r.randint(0, 5), r.randint(0, 4)), (1, 2, r.randint(0, 3), r.randint(0, 4)), (1, 3, r.randint(0, 5), r.randint(0, 4)), (2, 3, r.randint(0, 5), r.randint(0, 4))]
        net = Q.Network(4)
        ids = [net.arc(*a) for a in arcs]
        total = net.solve(0, 3)
        cost = sum(net.flow(k) * a[3] for k, a in zip(ids, arcs))
        best = None
        for x01 in range(arcs[0][2] + 1):
            for x02 in range(arcs[1][2] + 1):
                for x12 in range(min(arcs[2][2], x01) + 1):
                    if x01 - x12 <= arcs[3][2] and x02 + x12 <= arcs[4][2]:
                        c = x01 * arcs[0][3] + x02 * arcs[1][3] + x12 * arcs[2][3] + (x01 - x12) * arcs[3][3] + (x02 + x12) * arcs[4][3]
                        key = (-(x01 + x02), c)
                        best = key if best is None else min(best, key)
        assert (-total, cost) == best
