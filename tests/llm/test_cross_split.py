import random

from siftwork.llm import cross_split as C

META = "image_id long, sha256 string, phash string, object_id string, institution string, sha string, split string, is_eval string"
SPLITS = "image_id long, split string, ph string"


def data(spark, n=300, seed=4):
    r = random.Random(seed)
    hashes = [r.getrandbits(64) for _ in range(n // 2)]
    meta, splits = [], []
    for i in range(n):
        h = r.choice(hashes)
        for _ in range(r.randrange(7)):
            h ^= 1 << r.randrange(64)
        ph = r.choice([f"{h:016x}", f"{h:016X} ", None, "", "xyz"]) if r.random() < 0.9 else None
        sha = r.choice([None, "", f"{r.randrange(n):064x}", f"{r.randrange(n):064X} "])
        meta.append((i, sha, ph, r.choice([f"o{r.randrange(n)}", f" O{r.randrange(n)}", None, " "]), "I", "a", "b", "c"))
        if r.random() < 0.95:
            splits.append((i, r.choice(["train", "Train ", "train", "validation", "TEST", "other", None]), "x"))
    splits.append((n + 5, "train", "x"))
    return spark.createDataFrame(meta + meta[:9], META), spark.createDataFrame(splits + splits[:9], SPLITS), meta, splits


def brute(meta, splits):
    sp = {i: s.strip().lower() for i, s, _ in splits if s and s.strip().lower() in ("train", "validation", "test")}
    rec = []
    for i, sha, ph, obj, *_ in meta:
        if i in sp:
            p = (ph or "").strip().lower()
            rec.append((i, (sha or "").strip().lower(), int(p, 16) if len(p) == 16 else None, (obj or "").strip().lower(), sp[i]))
    out = set()
    for a in rec:
        for b in rec:
            if a[4] == "train" and b[4] != "train" and (a[1] and a[1] == b[1] or a[3] and a[3] == b[3] or a[2] is not None and b[2] is not None and bin(a[2] ^ b[2]).count("1") <= 4):
                out.add((a[0], b[0]))
    return out


def test_pairs_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "SHARD", 400)
    for seed in (4, 5):
        meta, splits, m, s = data(spark, seed=seed)
        got = [(r.train_id, r.eval_id) for r in C.overlaps(meta, splits)[1].collect()]
        assert len(got) == len(set(got)) and set(got) == brute(m, s)


def test_hot_pieces_are_split_further(spark, monkeypatch):
    for hot in (0, 3, 10):
        monkeypatch.setattr(C, "HOT", hot)
        meta, splits, m, s = data(spark, seed=6)
        m = [(i, None, f"{0xABCD << 48 | (i * 2654435761) % 65536:016x}" if i % 3 == 0 else p, o, *r) for i, _, p, o, *r in m]
        got = [(r.train_id, r.eval_id) for r in C.overlaps(spark.createDataFrame(m, META), splits)[1].collect()]
        assert len(got) == len(set(got)) and set(got) == brute(m, s)


def test_report_counts(spark):
    meta, splits, m, s = data(spark)
    want = brute(m, s)
    rows = C.overlap_report(meta, splits).collect()
    assert sum(r.pairs for r in rows) == len(want) and sum(r.overlapping for r in rows) == len({e for _, e in want})


def test_hot_keys_and_every_distance(spark):
    base = 0x0123456789ABCDEF
    meta = [(i, "AB" * 32, f"{base ^ ((1 << d) - 1):016x}", f"o{i}", "I", "", "", "") for i, d in enumerate([0, 1, 2, 3, 4, 5, 6])]
    meta = [(i, None, p, o, *r) for i, _, p, o, *r in meta]
    splits = [(i, "test" if i == 0 else "train", "") for i in range(7)]
    m, sp = spark.createDataFrame(meta, META), spark.createDataFrame(splits, SPLITS)
    pairs = {r.train_id: (r.distance, r.kinds) for r in C.overlaps(m, sp)[1].collect()}
    assert pairs == {d: (d, "p") for d in (1, 2, 3, 4)}
    (r,) = C.evaluation_coverage(m, sp).collect()
    assert (r.image_id, r.train_records, r.kinds) == (0, 4, "p") and abs(r.coverage - 15 / 18) < 1e-9  # the last digit differs; object o0 isn't covered


def test_coverage_merges_the_matches_of_all_training_records(spark):
    meta = [(0, "ab", "00000000000000ff", "obj", "I", "", "", ""), (1, None, "00000000000000fe", None, "I", "", "", ""), (2, "AB ", "10000000000000ff", None, "I", "", "", ""), (3, None, None, "OBJ", "I", "", "", ""), (4, "cd", "ffffffffffffff00", "none", "I", "", "", "")]
    splits = [(0, "validation", ""), (1, "train", ""), (2, "train", ""), (3, "train", ""), (4, "test", "")]
    got = [tuple(r) for r in C.evaluation_coverage(spark.createDataFrame(meta, META), spark.createDataFrame(splits, SPLITS)).collect()]
    assert got == [(0, "validation", 3, "ops", 1.0)]


def test_more_pieces_find_the_same_pairs(spark, monkeypatch):
    scheme = C.hamming_scheme
    monkeypatch.setattr(C, "hamming_scheme", lambda n, d: scheme(10**8, d))
    monkeypatch.setattr(C, "HOT", 2)
    meta, splits, m, s = data(spark, seed=9)
    got = [(r.train_id, r.eval_id) for r in C.overlaps(meta, splits)[1].collect()]
    assert len(got) == len(set(got)) and set(got) == brute(m, s)


def test_empty(spark):
    meta, splits, *_ = data(spark, 20)
    assert C.overlaps(meta.where("false"), splits)[1].count() == 0
    assert C.overlaps(meta, splits.where("false"))[1].count() == 0
    assert C.overlap_report(meta, splits.where("false")).count() == 0
