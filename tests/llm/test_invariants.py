"""What must hold of the queries that SQL can't say, on the smallest tables."""

from collections import Counter

import pytest

from siftwork.llm import plans
from siftwork.llm.related_splits import RATIOS, SPLITS

Q = plans.queries()


@pytest.fixture(scope="module")
def got(spark, tiny):
    held = {}

    def run(name):
        if name not in held:
            held[name] = Q[name](spark, tiny).collect()
        return held[name]

    return run


def test_sample_is_what_the_report_says(got):
    rows = got("p2_sample")
    assert len({(r.plan_name, r.image_id) for r in rows}) == len(rows)
    want = Counter()
    for r in got("p2_report"):
        want[r.plan_name, r.category] += r.drawn
    assert Counter((r.plan_name, r.category) for r in rows) == +want


def test_splits_cover_all_and_keep_groups(spark, tiny, got):
    rows = got("p3_splits")
    ids = {r[0] for r in spark.read.parquet(f"{tiny}/metadata.parquet").select("image_id").distinct().collect()}
    assert {r.image_id for r in rows} == ids and len(rows) == len(ids)
    split = {}
    assert all(split.setdefault(r.group_id, r.split) == r.split for r in rows)
    found = {(r.group_image_id, r.image_id) for r in got("p3_found")}
    assert found == {(r.group_id, r.image_id) for r in rows if r.n_objects > 1}
    n = Counter(r.split for r in rows)
    report = {r.split: r for r in got("p3_report")}
    assert all(report[s].records == n[s] and abs(n[s] / len(rows) - share) < 0.05 for s, share in zip(SPLITS, RATIOS))
    labels = Counter((r.label, r.split) for r in rows)
    assert all(labels[r.label, r.split] == r.records for r in got("p3_labels")) and sum(r.records for r in got("p3_labels")) == len(rows)


def test_leaks_agree(got):
    leaks = {(r.doc_id, r.item_id): r for r in got("p6_leaks")}
    assert {(r.doc_id, r.item_id) for r in got("p6_found")} == {k for k, r in leaks.items() if r.longest_run >= 12}
    assert {(r.doc_id, r.item_id) for r in got("p6_edited")} == {k for k, r in leaks.items() if r.coverage >= 0.5 and r.matched >= 12}
    n = Counter(r.item_id for r in got("p6_found"))
    assert {r.item_id: r.documents for r in got("p6_items")} == n
    assert all(0 < r.matched <= r.item_words and r.score <= 2 * r.matched for r in leaks.values())


def test_mix_is_what_the_report_says(spark, tiny, got):
    used = Counter()
    for r in got("p7_mix"):
        used[r.mix_id] += r.last_token - r.first_token
    report = got("p7_report")
    assert {r.mix_id: r.tokens for r in report if r.tokens} == used
    assert {r.mix_id for r in got("p7_found")} == {r.mix_id for r in report if r.tokens < r.wanted}
    most = {r.mix_id: r.max_repeats or 1 for r in spark.read.parquet(f"{tiny}/mix_targets.parquet").collect()}
    assert all(r.most_repeats <= most[r.mix_id] and r.tokens < r.wanted + 1 for r in report)


def test_pieces_cover_the_oversized(got):
    last = {}
    for r in sorted(got("p8_pieces"), key=lambda r: (r.doc_id, r.piece)):
        assert r.last_token - r.first_token <= 1000 and r.first_token == max(0, last.get(r.doc_id, 64) - 64)
        last[r.doc_id] = r.last_token
    assert set(last) == {r.doc_id for r in got("p8_found")}
    assert all(last[r.doc_id] == r.n_tokens for r in got("p8_pieces"))
