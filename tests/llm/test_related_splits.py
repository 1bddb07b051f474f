import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from siftwork.llm import related_splits as S

SHAPE = "image_id long, object_id string, media_id string, category_code string, obj string, group_id int"


def data(spark, n=500, seed=2, hot=0.33):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        obj = "ALBUM" if r.random() < hot else f"o{r.randrange(n // 3)}"
        media = r.choice([f"m{r.randrange(n)}", f" M{r.randrange(n)}", None, "n/a", "-", ""])
        rows.append((i, r.choice([obj, obj.upper(), f" {obj} "]), media, r.choice(["x", "y", None]), "z", 1))
    rows += [(n, None, None, "x", "", 0), (n + 1, "", "m1", "x", "", 0)]
    return spark.createDataFrame(rows + rows[::9], SHAPE), rows


def groups(rows):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    own = {}
    for i, o, m, *_ in rows:
        o = (o or "").strip().lower() or f"#{i}"
        own[i] = o
        find(("o", o))
        m = (m or "").strip().lower()
        if any(c.isdigit() for c in m):
            up[find(("m", m))] = find(("o", o))
    by = defaultdict(set)
    for i, o in own.items():
        by[find(("o", o))].add(i)
    return by, own


def test_groups_equal_union_find(spark):
    for seed in (2, 3):
        df, rows = data(spark, seed=seed)
        by, own = groups(rows)
        want = {(min(g), i) for g in by.values() if len({own[i] for i in g}) > 1 for i in g}
        got = [tuple(r) for r in S.spanning_groups(df).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_long_chains(spark):
    rows = [(i, f"o{i // 2}", f"m{(i + 1) // 2}", "x", "", 0) for i in range(200)]
    got = S.spanning_groups(spark.createDataFrame(rows, SHAPE)).collect()
    assert len(got) == 200 and {r.group_image_id for r in got} == {0}


def test_splits_keep_groups_and_shares(spark):
    df, rows = data(spark, 900, hot=0.3)
    by, _ = groups(rows)
    out = {r.image_id: r.split for r in S.assign_splits(df).collect()}
    assert set(out) == {r[0] for r in rows}
    assert all(len({out[i] for i in g}) == 1 for g in by.values())
    n = Counter(out.values())
    assert abs(n["train"] / len(out) - 0.8) < 0.02 and abs(n["test"] / len(out) - 0.1) < 0.02
    again = {r.image_id: r.split for r in S.assign_splits(df.repartition(5)).collect()}
    assert again == out


def test_several_shards(spark, monkeypatch):
    df, rows = data(spark, 900, hot=0.1)
    monkeypatch.setattr(S, "SHARD", 60)
    n = Counter(r.split for r in S.assign_splits(df).collect())
    assert abs(n["train"] / len(rows) - 0.8) < 0.03


def test_annealing_is_never_worse_than_its_start():
    r = np.random.default_rng(0)
    v = r.integers(1, 9, (80, 3)).astype(float)
    v[:, 0] = v[:, 1:].sum(axis=1)
    want = np.outer([0.8, 0.1, 0.1], v.sum(axis=0))
    start = r.integers(0, 3, 80)

    def cost(a):
        load = np.zeros_like(want)
        np.add.at(load, a, v)
        off = ((load - want) / want.sum(axis=0)) ** 2
        return off[:, 0].sum() + off[:, 1:].sum() / 2

    assert cost(S.anneal(v, start, want, 1)) < cost(start) / 100


def test_report_empty_and_bad_ratios(spark):
    df, _ = data(spark, 60)
    assert S.spanning_groups(df.where("false")).count() == 0
    report = {r.split: r for r in S.split_report(S.assign_splits(df.where("false"))).collect()}
    assert report["train"].records == 0 and report["train"].share == 0.0
    with pytest.raises(ValueError):
        S.assign_splits(df, ratios=(0.8, 0.1, 0.2))


@pytest.mark.parametrize("shard", [20_000, 150])
def test_labels_are_near_their_shares_beside_a_heavy_component(spark, monkeypatch, shard):
    monkeypatch.setattr(S, "SHARD", shard)
    r = random.Random(4)
    rows = [(i, "ALBUM" if i < 600 else f"o{i}", None, "x" if i < 600 else r.choice("xxyyyz"), "", 0) for i in range(1800)]
    out = {r.image_id: r.split for r in S.assign_splits(spark.createDataFrame(rows, SHAPE)).collect()}
    assert len({out[i] for i in range(600)}) == 1
    n = Counter((c, out[i]) for i, _, _, c, *_ in rows)
    every = Counter(c for _, _, _, c, *_ in rows)
    told = {(r.label, r.split): r for r in S.label_report(S.assign_splits(spark.createDataFrame(rows, SHAPE))).collect()}
    assert all(told[c, s].records == n[c, s] for c in "xyz" for s in S.SPLITS) and max(abs(r.deviation) for r in told.values()) < 0.02
    for c in "xyz":
        for split, share in zip(S.SPLITS, S.RATIOS):
            assert abs(n[c, split] / every[c] - share) < 0.02, (c, split, n)
