import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from scorewright.llm import hamming, simhash
from scorewright.llm.components import connected_components


def plain_fingerprint(text):
    import re
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    if not w:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 4]), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(fps, most=4):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= most:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_hash_is_sparks_xxhash64(spark):
    words = ["", "a", "a b c d", "héllo wörld çà et là", "x" * 200]
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", F.xxhash64("w").alias("h"))
    for r in df.collect():
        assert r.h % (1 << 64) == xxhash.xxh64_intdigest(r.w.encode(), 42)


def test_fingerprint_equals_definition(edge_rows):
    for _, t, *_ in edge_rows:
        if t is None or len(t) < 5000:
            assert simhash.fingerprint((t or "").encode()) == plain_fingerprint(t)


def test_gray_rank_orders_the_gray_sequence():
    n = np.arange(512, dtype=np.uint64)
    assert (hamming.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


def test_bucket_links_equal_brute_force():
    rng = random.Random(5)
    for trial in range(25):
        centres = [rng.getrandbits(64) for _ in range(rng.randrange(1, 6))]
        values = set()
        for _ in range(rng.randrange(1, 120)):
            v = rng.choice(centres)
            for _ in range(rng.randrange(0, 9)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
        values = sorted(values)
        arr = np.array(values, np.uint64)
        bucket = np.zeros(len(arr), np.int64)
        yes = np.ones(len(arr), bool)
        a, b = hamming.bucket_links(bucket, arr, yes, yes, 4)
        at = {v: i for i, v in enumerate(values)}
        for x, y in zip(a.tolist(), b.tolist()):
            assert 0 < len(values)
        mine = hamming.star(len(arr), np.array([at[x] for x in a.tolist()], int), np.array([at[x] for x in b.tolist()], int))
        plain = plain_components(values)
        assert len(set(zip(mine.tolist(), plain))) == len(set(mine.tolist())) == len(set(plain))


def test_disjoint_sides_find_all_cross_links():
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    values = [centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(7))) for _ in range(200)]
    values = sorted(set(values))
    arr, side = np.array(values, np.uint64), np.arange(len(values)) % 2 == 0
    a, b = hamming.bucket_links(np.zeros(len(arr), np.int64), arr, side, ~side, 4)
    at = {v: i for i, v in enumerate(values)}
    mine = hamming.star(len(arr), np.array([at[x] for x in a.tolist()], int), np.array([at[x] for x in b.tolist()], int))
    for i in range(len(values)):
        for j in range(len(values)):
            if side[i] and not side[j] and bin(values[i] ^ values[j]).count("1") <= 4:
                assert mine[i] == mine[j]


def test_block_keys_keep_every_link_at_every_size(spark):
    rng = random.Random(7)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << x for x in rng.sample(range(64), 4))
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    df = spark.createDataFrame(pairs, "a long, b long")
    for rows in (1000, 10**8, 10**10, 10**12):
        both = df.select(F.array_intersect(simhash.block_keys(F.col("a"), rows), simhash.block_keys(F.col("b"), rows)).alias("x"))
        assert both.filter(F.size("x") == 0).count() == 0


def test_chunked_buckets_give_the_same_components(spark):
    rng = random.Random(8)
    centre = rng.getrandbits(63)
    fps = sorted({centre ^ sum(1 << b for b in rng.sample(range(63), rng.randrange(6))) for _ in range(300)})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    links = simhash.fingerprint_links(df, chunk=16)
    got = {r.node: r.component for r in connected_components(links).collect()}
    plain = plain_components(fps)
    mine = [got.get(x, x) for x in fps]
    assert len(set(zip(mine, plain))) == len(set(mine)) == len(set(plain))


def test_components_and_keep_one_on_edge_rows(edge_docs, edge_rows):
    rows = simhash.simhash_components(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    ids = [i for i, *_ in edge_rows]
    fps = [plain_fingerprint(t) if t is None or len(t) < 5000 else simhash.fingerprint(t.encode()) for _, t, *_ in edge_rows]
    root = plain_components(fps)
    least = {r: min((i for i, q in zip(ids, root) if q == r and i is not None), default=None) for r in set(root)}
    expected = sorted(((i, f, least[r]) for i, f, r in zip(ids, fps, root)), key=str)
    assert sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in rows), key=str) == expected
    kept = simhash.keep_one(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(least.values(), key=str)


def test_empty_table(no_docs):
    assert simhash.simhash_components(no_docs).collect() == []
    assert simhash.keep_one(no_docs).collect() == []


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    hub = [(1000, i) for i in range(1001, 1200)]
    extra = [(5, 5), (None, 7), (100, 101), (101, 100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(path + hub + extra, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 1000 for i in range(1000, 1200)}
