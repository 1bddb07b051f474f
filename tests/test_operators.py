import random

import pytest
from pyspark.sql import functions as F

from siftwork.operators import decide, dedup, graph, profile, release, sampling, search, splitting, validate
from siftwork.operators.graph import connected_components
from siftwork.plans import curation
from siftwork.session import cut


def test_staged_reasons_and_status(spark):
    df = spark.createDataFrame([(None, "x", 1), ("a", None, 1), ("a", "b", 9), ("a", "b", 1)], "a string, b string, c int").repartition(1)
    d = decide.decision([[decide.Rule("NO_A", F.col("a").isNull()), decide.Rule("NO_A", F.col("a").isNull())], [decide.Rule("NO_B", F.col("b").isNull())]], [decide.Rule("BIG", F.col("c") > 5), decide.Rule("NULL_RULE", F.lit(None).cast("boolean"))])
    got = [(r.d.status, r.d.reasons) for r in df.select(d.alias("d")).collect()]
    assert got == [("rejected", ["NO_A"]), ("rejected", ["NO_B"]), ("review_required", ["BIG"]), ("eligible", [])]


def test_useful_fields_and_titles(spark):
    df = spark.createDataFrame([("Untitled", "d"), ("Specimen #12", "d"), ("Bowl", None), (None, None)], "title string, description string").repartition(1)
    assert [r[0] for r in df.select(decide.useful_fields(("title", "description"), "title", ("untitled",), r"(?i)^(?:object|item|specimen|record)\s*[-#:]*\s*\d+$")).collect()] == [1, 1, 1, 0]


def test_decision_list_takes_the_first(spark):
    df = spark.createDataFrame([("blueprint of an engine",), ("engine",), (None,)], "t string").repartition(1)
    e = decide.decision_list([(decide.keyword_rule(["t"], ["print"]), "paper"), (decide.keyword_rule(["t"], ["engine"]), "engines")], "other")
    assert [r[0] for r in df.select(e).collect()] == ["paper", "engines", "other"]


def test_lookup_of_a_missing_code_is_an_error(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert {r[0] for r in df.select(decide.lookup("c", {"a": "A"})).collect()} == {"A", None}
    with pytest.raises(Exception, match="no label"):
        df.select(decide.lookup("c", {"b": "B"})).collect()


def test_components_against_union_find(spark):
    r = random.Random(5)
    for n, m in ((60, 40), (200, 260), (1, 0)):
        edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)] + [(None, 1), (3, None)]
        up = list(range(n))

        def find(x):
            while up[x] != x:
                x = up[x]
            return x

        for a, b in edges:
            if a is not None and b is not None:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
        nodes = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
        got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
        assert got == {x: find(x) for x in nodes}


def test_components_of_a_star_and_a_chain(spark):
    star = [(0, i) for i in range(1, 500)] + [(i, i + 1) for i in range(1000, 1300)]
    got = connected_components(spark.createDataFrame(star, "a long, b long")).groupBy("component").count().collect()
    assert {r.component: r["count"] for r in got} == {0: 500, 1000: 301}


def _plans(monkeypatch, module):
    """The plans of the tables that ``module`` cuts from now on, as they stand before they run."""
    plans = []
    monkeypatch.setattr(module, "cut", lambda df, at: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, at))
    return plans


def test_component_steps_broadcast_no_side_by_its_file_size(spark, monkeypatch):
    """The edges of a round are read from compressed files, which are far below Spark's bound whatever they hold."""
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 50 + i) for i in range(1, 40)], "a long, b long")
    plans = _plans(monkeypatch, graph)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 if i < 50 else 50 for i in [*range(41), *range(50, 90)]}
    assert len(plans) > 1 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans[1:])  # the first cut has the edges as given


@pytest.mark.parametrize("hot, codes_seen", [(20_000, None), (2, None), (2, 10**8)])
def test_hamming_pairs_against_brute_force(spark, monkeypatch, hot, codes_seen):
    monkeypatch.setattr(dedup, "HOT", hot)
    scheme = dedup.hamming_scheme
    monkeypatch.setattr(dedup, "hamming_scheme", lambda n, d: scheme(codes_seen or n, d))
    r = random.Random(8)
    codes = [r.getrandbits(64) for _ in range(40)]
    rows = [(i, (lambda x: x - (1 << 64) if x >> 63 else x)(r.choice(codes) ^ sum(1 << b for b in r.sample(range(64), r.randrange(6)))), r.choice("pq")) for i in range(200)] + [(900, None, "p")]
    for d in (0, 2, 4):
        want = {(a, b) for a, x, s in rows for b, y, t in rows if x is not None and y is not None and a < b and s != t and bin((x ^ y) & (2**64 - 1)).count("1") <= d}
        got = [(x.a, x.b) for x in dedup.hamming_pairs(spark.createDataFrame(rows, "id long, h long, s string"), "id", "h", d, "s").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def greedy(rows, quotas, views, inst):
    objs, insts, out = {}, {}, set()
    for c, q in quotas.items():
        n = 0
        for h, i, cat, o, u in sorted(rows):
            if cat == c and n < q and objs.get(o, 0) < views and insts.get(u, 0) < inst:
                n += 1
                out.add(i)
                objs[o] = objs.get(o, 0) + 1
                insts[u] = insts.get(u, 0) + 1
    return out


@pytest.mark.parametrize("functional, stretch", [(True, 37), (False, 37), (False, 200_000)])
def test_greedy_quotas_equal_the_loop(spark, functional, stretch, monkeypatch):
    monkeypatch.setattr(sampling, "CHUNK_ROWS", stretch)
    r = random.Random(9)
    rows = [(r.random(), i, r.choice("abc"), o := r.randrange(30), (o % 4) if functional else r.randrange(4)) for i in range(250)]
    df = spark.createDataFrame(rows, "h double, id long, c string, o long, u long")
    quotas = {"b": 40, "a": 30, "c": 50}
    got = {x.id for x in sampling.greedy_quotas(df, "c", quotas, ["h", "id"], "o", 3, "u", 22).collect()}
    assert got == greedy(rows, quotas, 3, 22)


def test_allocation(spark):
    assert sampling.largest_remainder({"a": 1, "b": 1, "c": 1}, 10) == {"a": 4, "b": 3, "c": 3}
    with pytest.raises(ValueError):
        sampling.largest_remainder({"a": 0}, 1)
    r = random.Random(2)
    weights = {f"k{i}": r.randrange(1, 50) for i in range(20)}
    got = {x.k: x.quota for x in sampling.allocate(spark.createDataFrame(list(weights.items()), "k string, w long"), "k", "w", 137).collect()}
    assert got == sampling.largest_remainder(weights, 137)


def test_global_rank_is_total(spark):
    df = spark.createDataFrame([((i * 7919) % 1000, i) for i in range(1000)], "x long, y long").repartition(7)
    got = sampling.global_rank(df, ["x"], "rank").collect()
    assert [r.rank for r in sorted(got, key=lambda r: r.x)] == list(range(1, 1001))
    assert sampling.global_rank(df.where("false"), ["x"]).count() == 0


def test_round_robin_cap_equals_the_loop(spark):
    r = random.Random(4)
    rows = [(s, u, i) for s in range(4) for u in range(3) for i in range(r.randrange(6))]
    got = {tuple(x) for x in sampling.round_robin_cap(spark.createDataFrame(rows, "s long, u long, i long"), "u", ["s", "u", "i"], 7, 15).collect()}
    n, out = {}, []
    for row in sorted(rows):
        if len(out) < 15 and n.get(row[1], 0) < 7:
            n[row[1]] = n.get(row[1], 0) + 1
            out.append(row)
    assert got == set(out)
    with pytest.raises(ValueError):
        sampling.round_robin_cap(spark.range(1), "id", ["id"], 0, 1)


def test_object_splits(spark):
    df = spark.createDataFrame([("a", "art"), ("a", "art"), ("b", "art"), ("c", "sci"), ("d", "sci"), ("e", "sci")], "o string, c string")
    out = splitting.assign_object_splits(df, "o", "c", "s").collect()
    assert {r.o for r in out} == set("abcde") and sorted(out) == sorted(splitting.assign_object_splits(df.repartition(3), "o", "c", "s").collect())
    with pytest.raises(ValueError):
        splitting.assign_object_splits(df, "o", "c", "s", (0.8, 0.1, 0.2))
    with pytest.raises(ValueError):
        splitting.assign_object_splits(df.union(spark.createDataFrame([(None, "x")], df.schema)), "o", "c", "s")


def test_split_chunks_change_nothing(spark, monkeypatch):
    r = random.Random(3)
    rows = [(f"o{i}", r.choice("abb"), r.randrange(4)) for i in range(700) for _ in range(r.randrange(1, 4))]
    df = spark.createDataFrame(rows, "o string, c string, x int")
    want = sorted(splitting.assign_object_splits(df, "o", "c", "s").collect())
    monkeypatch.setattr(splitting, "CHUNK", 90)
    assert sorted(splitting.assign_object_splits(df, "o", "c", "s").collect()) == want


def test_percentiles_equal_numpy(spark):
    import numpy as np

    r = random.Random(6)
    values = [r.choice([0.0, 5.0, r.uniform(-9, 9)]) for _ in range(501)]
    df = spark.createDataFrame([(x,) for x in values] + [(None,)], "x double")
    parts = (0.0, 0.1, 0.5, 0.95, 1.0)
    assert np.allclose(profile.percentiles(df, "x", parts), np.quantile(values, parts))
    assert profile.percentiles(df.where("false"), "x", parts) == [None] * 5
    assert tuple(profile.summary(df.where("false"), "x").first()) == (0, None, None, None, None, None)


def test_first_rows_beyond_one_task(spark, monkeypatch):
    df = spark.range(3000).select(((F.col("id") * 7919) % 3000).alias("x")).repartition(5)
    monkeypatch.setattr(sampling, "GATHER", 10)
    assert sorted(r.x for r in sampling.first_rows(df, ["x"], 1200).collect()) == list(range(1200))
    assert len(sampling.hash_sample(df, "s", "x", 50).collect()) == 50


def test_units_caps_and_pilot(spark):
    df = spark.createDataFrame([(i, "abc"[i % 3], f"{i * 37 % 100:02d}") for i in range(90)], "id long, u string, h string")
    assert [tuple(r) for r in sampling.requested_units(["c", "a", "c"], df, "u").orderBy("pos").collect()] == [(0, "c"), (1, "a")]
    with pytest.raises(ValueError, match="unknown units: z"):
        sampling.requested_units(["a", "z"], df, "u")
    capped = sampling.unit_caps(df, "u", 20, {"a": 5, "b": 50})
    assert {(r.u, r.cap) for r in capped.select("u", "cap").distinct().collect()} == {("a", 5), ("b", 20), ("c", 20)}
    with pytest.raises(ValueError):
        sampling.unit_caps(df, "u", 20, {"a": 0})
    got = sampling.round_robin_cap(capped, "u", ["id"], F.col("cap"), 30)
    told = {r.u: tuple(r)[1:] for r in sampling.scan_report(capped, "u", ["id"], 30).collect()}
    emitted = {r.u: r["count"] for r in got.groupBy("u").count().collect()}
    assert emitted == {u: t[2] for u, t in told.items()} and sum(emitted.values()) == 30 and told["a"] == (30, 5, 5, True)
    out = sampling.pilot(df, "u", {"a": 3, "b": 2}, ["h", "id"]).orderBy("pilot_id").collect()
    assert [r.pilot_id for r in out] == [1, 2, 3, 4, 5] and [r.h for r in out] == sorted(r.h for r in out)
    with pytest.raises(ValueError):
        sampling.pilot(df, "u", {"a": 31}, ["h", "id"])
    with pytest.raises(ValueError):
        sampling.greedy_quotas(df, "u", {"a": 31}, ["h", "id"], "id", 2, fill=True)


def test_primary_category_ties(spark):
    df = spark.createDataFrame([("o", "b"), ("o", "a"), ("p", None), ("p", "z"), ("p", "z")], "o string, c string")
    assert sorted(tuple(r) for r in splitting.primary_category(df, "o", "c").collect()) == [("o", "a", 2), ("p", "z", 3)]


def test_profiles_of_empty_tables(spark):
    df = spark.createDataFrame([], "a string, b long")
    assert [(r.missing, r.total, r.ratio) for r in profile.missing(df, ["a"]).collect()] == [(0, 0, 0.0)]
    assert profile.summary(df, "b").first().n == 0 and profile.summary(df, "b").first().p50 is None
    assert profile.package_projection(df, "b", 10, 0, 1, 2).first().verdict == "STOP"
    assert profile.usable_ratio(df, "a", ["x"]).first().ratio == 0.0


def test_release_tables(spark):
    log = spark.createDataFrame([(1, 1, "failed"), (1, 2, "success"), (2, 1, "success"), (2, 2, "failed"), (None, 1, "success")], "id long, seq long, status string")
    want = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    ok = F.col("status") == "success"
    assert sorted(r.id for r in release.unresolved(want, log, "id", ["seq"], ok).collect()) == [2, 3]
    assert {r.state: r.n for r in release.completion(want, log, "id", ["seq"], ok).collect()} == {"complete": 1, "failed": 1, "pending": 1}
    lines = spark.createDataFrame([("a" * 64 + "  x y.txt",), ("b" * 64 + "  z",), ("nonsense",), ("",), ("c" * 64 + "  gone",)], "value string")
    actual = spark.createDataFrame([("x y.txt", "a" * 64), ("z", "d" * 64)], "path string, sha256 string")
    assert {r.path: r.verdict for r in release.verify_checksums(lines, actual).collect()} == {"x y.txt": "ok", "z": "mismatch", "nonsense": "invalid", "gone": "missing"}
    text, total = release.settle_size(10**6, lambda gb: f"{{{gb}}}")
    assert total == 10**6 + len(text) and str(round(total / 1e9, 6)) in text
    assert '"type": "integer"' in release.descriptor({"a.csv": (want, "ids")})
    docs = spark.createDataFrame([("t", 0, "a", "A"), ("t", 1, "b", "B")], "table string, pos int, name string, description string")
    live = spark.createDataFrame([("t", 0, "a", "A"), ("t", 1, "x", None)], docs.schema)
    assert [(r.exact, r.present) for r in release.described_columns(docs, live).orderBy("pos").collect()] == [(True, True), (False, False)]


def test_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "x long")
    out = validate.run_checks(df, [validate.Check("DUP", validate.duplicates("x"), most=0), validate.Check("ROWS", F.count("*"), 3, 3), validate.Check("NULLS", validate.violations(F.col("x") < 0), most=0)])
    assert {r.code: r.passed for r in out.collect()} == {"DUP": False, "ROWS": True, "NULLS": False}
    assert tuple(validate.verdict(out).first()) == ("FAIL", "DUP|NULLS")
    assert tuple(validate.verdict(out.where("passed")).first()) == ("PASS", "")
    assert validate.require(df.where("x = 1"), F.col("x") == 1, "no").count() == 2
    with pytest.raises(Exception, match="bad row"):
        validate.require(df, F.col("x") == 1, "bad row").collect()


def test_search(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert [(r.vec_id, round(r.score, 6)) for r in search.top_k(df, [5.0, 0.0], 2).collect()] == [(1, 1.0), (2, 1.0)]
    with pytest.raises(ValueError):
        search.top_k(df, [1.0], 0)


def test_long_top_lists_are_salted(spark):
    df = spark.range(5000).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 5000).alias("x"))
    got = [r.x for r in sampling.top_per_group(df, "g", ["x"], 1500).collect()]
    assert sorted(got) == list(range(1500))


def test_lists_and_members_of_groups(spark):
    rows = [(1, "k", "a", "u"), (2, "k", "b", None), (3, "k", "b", "u"), (4, "k", "c", "v"), (5, "l", "a", "u"), (6, " ", "a", "u")]
    df = spark.createDataFrame(rows, "id long, k string, o string, u string")
    assert [tuple(r) for r in dedup.grouped_ids(df, "k", "id", "o").collect()] == [("k", 4, "1; 2; 3; 4", "a; b; c")]
    assert [tuple(r) for r in dedup.shared_keys(df, "k", "o", "u").collect()] == [("k", 3, 4, "a; b; c", "u; v")]
    assert {tuple(r) for r in dedup.shared_objects(df, "k", "o", "u").collect()} == {("k", "a", "u", 1), ("k", "b", None, 1), ("k", "b", "u", 1), ("k", "c", "v", 1)}
    assert {tuple(r) for r in dedup.duplicate_groups(df, "k", "id").collect()} == {("k", i, 4) for i in range(1, 5)}
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4)], "a long, b long")
    assert [tuple(r) for r in dedup.near_components(pairs, df, "id", "o", objects="o", units="u").collect()] == [(1, 1, 4, 3, "1; 2; 3; 4", "a; b; c", "; u; v")]
    assert {tuple(r) for r in dedup.component_members(pairs).collect()} == {(1, i) for i in range(1, 5)}


def test_pairs_broadcast_no_side_by_its_file_size(spark, tmp_path):
    """Compressed files are far below Spark's bound of 10 MB, whatever is read from them."""
    spark.range(600).selectExpr("id", "id * 3 AS h", "CAST(id % 5 AS STRING) AS s").write.parquet(f"{tmp_path}/codes")
    pairs = dedup.hamming_pairs(spark.read.parquet(f"{tmp_path}/codes"), "id", "h", 2, "s")
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
    want = {(a, b, d) for a in range(600) for b in range(a + 1, 600) if a % 5 != b % 5 and (d := (a * 3 ^ b * 3).bit_count()) <= 2}
    assert {tuple(r) for r in pairs.collect()} == want != set()


@pytest.mark.parametrize("name", ["near_component_lists", "near_component_members", "near_components"])
def test_near_components_broadcast_no_side_of_the_pairs(spark, monkeypatch, tiny, name):
    plans = []
    monkeypatch.setattr(graph, "cut", lambda df, at: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df, at))
    assert curation.R.queries[name](spark, tiny).count() > 0
    assert "SortMergeJoin" in plans[0] and "Broadcast" not in plans[0]  # the first cut has the pairs


def test_near_component_members_broadcasts_no_side_in_any_round(spark, monkeypatch, tiny):
    plans = _plans(monkeypatch, graph)
    got = {tuple(r) for r in curation.R.queries["near_component_members"](spark, tiny).collect()}
    assert len(plans) > 2 and all("SortMergeJoin" in p and "Broadcast" not in p for p in plans)
    assert len({i for _, i in got}) == len(got) > 0 and all((first, first) in got and first <= i for first, i in got)


@pytest.mark.parametrize("ids, others, other", [(10**6, 4, "o"), (12, 2, "o"), (4, 3, "o"), (12, 2, None)])
def test_edges_have_the_components_of_the_pairs(spark, ids, others, other):
    """Ids that stand once, and ids with several codes; codes of one other value, of several, and of null."""
    rng = random.Random(ids)
    base = [rng.getrandbits(63) for _ in range(12)]
    rows = [(rng.randrange(ids), rng.choice(base) ^ (1 << rng.randrange(10)) ^ (1 << rng.randrange(10)), rng.choice([None, "", *map(str, range(others))])) for _ in range(60)] + [(None, base[0], "0"), (1, None, "0")]
    rows += [(5 * 10**6 + i, 1 << 40, "x") for i in range(4)] + [(6 * 10**6 + i, 1 << 60, None) for i in range(4)]  # one other only: no pairs
    df = spark.createDataFrame(rows, "id long, h long, o string")
    want = connected_components(dedup.hamming_pairs(df, "id", "h", 4, other).select("a", "b")).collect()
    got = connected_components(dedup.hamming_edges(df, "id", "h", 4, other)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) != []


def test_near_component_members_of_copies_have_an_edge_a_row_and_not_a_pair_each(spark, tmp_path, monkeypatch):
    """300 images of one perceptual hash and 300 files are 44,850 pairs."""
    spark.range(300).selectExpr("id AS image_id", "'o' AS object_id", "LPAD(HEX(id), 64, '0') AS sha256", "'00000000000000ff' AS phash").write.parquet(f"{tmp_path}/metadata.parquet")
    rows = []
    monkeypatch.setattr(graph, "cut", lambda df, at: rows.append((out := cut(df, at)).count()) or out)
    got = curation.R.queries["near_component_members"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in got} == {(0, i) for i in range(300)} and rows and max(rows) < 300


def test_near_components_of_copies_have_an_edge_a_row_and_broadcast_no_groups(spark, tmp_path, monkeypatch):
    """300 images of one perceptual hash and 300 files are 44,850 pairs; whole-row copies count once."""
    spark.range(310).selectExpr("id % 300 AS image_id", "CONCAT('o', id % 300 % 7) AS object_id", "LPAD(HEX(id % 300), 64, '0') AS sha256", "'00000000000000ff' AS phash").write.parquet(f"{tmp_path}/metadata.parquet")
    rows, plans = [], _plans(monkeypatch, sampling)
    monkeypatch.setattr(graph, "cut", lambda df, at: rows.append((out := cut(df, at)).count()) or out)
    got = curation.R.queries["near_components"](spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [(1, 0, 300, 7, "; ".join(map(str, range(300))))] and rows and max(rows) < 300
    assert "SortMergeJoin [first_id" in plans[0] and "Broadcast" not in plans[0]


def _joins_of_members(spark, tmp_path, monkeypatch, **lists):
    """(result, its plan before it runs) of near components over members read from files of a few kB."""
    spark.range(60).selectExpr("id", "CONCAT('o', id % 4) AS o", "CONCAT('u', id % 3) AS u").write.parquet(f"{tmp_path}/members")
    pairs = spark.createDataFrame([(i, i + 1) for i in range(0, 40, 2)] + [(50, 50 + i) for i in range(1, 8)], "a long, b long")
    plans = _plans(monkeypatch, sampling)
    got = [tuple(r) for r in dedup.near_components(pairs, spark.read.parquet(f"{tmp_path}/members"), "id", "o", **lists).collect()]
    return sorted(got), plans[0]


def test_near_component_lists_broadcast_neither_components_nor_members(spark, tmp_path, monkeypatch):
    got, plan = _joins_of_members(spark, tmp_path, monkeypatch, objects="o", units="u")
    assert got[0] == (1, 50, 8, 4, "; ".join(map(str, range(50, 58))), "o0; o1; o2; o3", "u0; u1; u2") and len(got) == 21
    assert "SortMergeJoin [id" in plan and "BroadcastHashJoin [id" not in plan


def test_near_components_without_lists_broadcast_neither_components_nor_members(spark, tmp_path, monkeypatch):
    got, plan = _joins_of_members(spark, tmp_path, monkeypatch)
    assert got[:2] == [(1, 50, 8, 4, "; ".join(map(str, range(50, 58)))), (2, 0, 2, 2, "0; 1")] and len(got) == 21
    assert "SortMergeJoin [id" in plan and "BroadcastHashJoin [id" not in plan


def test_pieces_grow_with_the_codes():
    sets = [len(dedup.hamming_scheme(n, 4)[1]) for n in (10**3, 10**6, 10**7, 10**9)]
    assert sets == sorted(sets) and sets[0] < sets[-1]
    for n in (10, 10**9):
        pieces, own = dedup.hamming_scheme(n, 4)
        assert sum(w for _, w in pieces) == 64 and all(len(x) == len(pieces) - 4 for x in own)


def test_many_queries_equal_brute_force(spark, monkeypatch):
    import numpy as np

    monkeypatch.setattr(search, "BLOCK", 3)
    r = np.random.default_rng(3)
    v = {i: r.integers(-2, 3, 4).astype(float).tolist() for i in range(120)}
    df = spark.createDataFrame([*v.items(), (None, [1.0] * 4), (500, None)], "vec_id long, embedding array<double>").repartition(5)
    unit = {i: np.array(x) / max(np.linalg.norm(x), 1e-12) for i, x in v.items()}
    got = {}
    for x in search.top_k_many(df, df.where("vec_id % 20 = 0"), 5).collect():
        got.setdefault(x.query_id, []).append(round(x.score, 9))
    for q in range(0, 120, 20):
        want = sorted((round(float(unit[q] @ u), 9) for u in unit.values()), reverse=True)[:5]
        assert np.allclose(sorted(got[q], reverse=True), want)
    assert search.top_k_many(df, df.where("false"), 5).count() == 0
