from itertools import combinations

from postsieve.llm import packing
from tests.llm.conftest import frame, odd_documents


def padding(bins, bounds):
    return sum(next(b for b in bounds if b >= top) * docs - tokens for top, docs, tokens in bins)


def test_bounds_are_optimal():
    bins = [(1, 5, 5), (2, 1, 2), (3, 9, 27), (7, 2, 14), (8, 4, 32), (20, 1, 20), (21, 3, 63)]
    tops = [b[0] for b in bins]
    for k in range(1, 8):
        best = min(padding(bins, [*c, 21]) for c in combinations(tops[:-1], k - 1))
        bounds = packing.best_bounds(bins, k)
        assert len(bounds) <= k and padding(bins, bounds) == best
    assert packing.best_bounds([], 3) == []


def test_batches_stay_in_budget(spark):
    docs = frame(spark, [(n, "w " * (n % 50 + 1), "en", "s", 0) for n in range(500)])
    rows = packing.pack(docs, buckets=4, budget=100, shard_rows=40).collect()
    assert len(rows) == 500
    batches = {}
    for r in rows:
        assert r["n_tokens"] == r["doc_id"] % 50 + 1 <= r["bound"]
        batches.setdefault((r["bucket"], r["shard"], r["batch"]), []).append(r)
    for batch in batches.values():
        assert len(batch) * batch[0]["bound"] <= 100
        assert sorted(r["slot"] for r in batch) == list(range(len(batch)))
    # Only the last batch of a shard may have room.
    for (bucket, shard, number), batch in batches.items():
        if (bucket, shard, number + 1) in batches:
            assert len(batch) == 100 // batch[0]["bound"]


def test_report_agrees_with_pack(spark):
    docs = odd_documents(spark)
    report = packing.packing_report(docs).collect()
    packed = packing.pack(docs).select("doc_id", *packing.ADDED).collect()
    assert sorted(map(str, report)) == sorted(map(str, packed))
    assert len(report) == 8
    assert [r["n_tokens"] for r in report if r["doc_id"] in (2, 3, 5)] == [0, 0, 0]
    assert packing.pack(docs.limit(0)).count() == 0


def test_bins_hold_their_lengths(spark):
    lengths = [0, 1, 1023, 1024, 1025, 4095, 4097, 10**6 + 1]
    rows = spark.createDataFrame([(n,) for n in lengths], "n_tokens long")
    tops = {r[0]: r[1] for r in rows.select("n_tokens", packing.length_bin(rows["n_tokens"])).collect()}
    for n, top in tops.items():
        assert n <= top <= n + max(0, n // 512) + 1
        assert n >= 1024 or top == n
