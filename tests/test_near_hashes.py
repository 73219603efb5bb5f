"""Near hashes: pairs by bands with probes, and leaders settled in rounds, against plain versions."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from granary.operators import dedup


def distance(a, b):
    return (int(a, 16) ^ int(b, 16)).bit_count()


def plain_leaders(rows, prefix, at_most):
    out, found = [], {}
    for name, digits in sorted(rows):
        known = found.setdefault(digits[:prefix], [])
        first = next((x for x in known if distance(x, digits) <= at_most), None)
        if first is None:
            known.append(first := digits)
        out.append((name, "near_" + first[:12]))
    return sorted(out)


def likely_near(rng, n, flips):
    """Hashes in families, of which each is a few bits from another."""
    out = [f"{rng.getrandbits(64):016x}" for _ in range(n // 5)]
    while len(out) < n:
        x = int(rng.choice(out), 16)
        for bit in rng.sample(range(64), rng.randint(0, flips)):
            x ^= 1 << bit
        out.append(f"{x:016x}")
    return out


@pytest.mark.parametrize("bits,at_most", [(48, 5), (56, 24), (64, 0), (60, 13), (4, 3), (4, 9), (64, 40), (52, 1)])
def test_bands_meet_all_that_is_near(bits, at_most):
    """Whatever bits differ, some band has no more of them than its radius, and no radius is wider than that takes."""
    plan = dedup.bands(bits, at_most)
    rng = random.Random(bits)
    assert all(s + w <= bits for s, w, _ in plan) and len({s for s, _, _ in plan}) == len(plan)
    if at_most < bits:
        for _ in range(500):
            ones = set(rng.sample(range(bits), rng.randint(0, at_most)))
            assert any(len(ones & set(range(s, s + w))) <= r for s, w, r in plan)


@pytest.mark.parametrize("prefix,at_most", [(4, 5), (2, 24), (0, 9), (0, 0), (1, 3), (15, 2), (16, 5)])
def test_pairs_against_all_pairs(spark, prefix, at_most):
    rng = random.Random(at_most)
    hashes = likely_near(rng, 300, at_most + 2)
    if prefix > 4:
        hashes = ["0" * 15 + h[15] for h in hashes]
    rows = list(enumerate(hashes)) + [(1000, "zz"), (1001, "zz"), (1002, "z"), (1003, None), (None, hashes[0])]
    got = dedup.similar_pairs(spark.createDataFrame(rows, "id long, h string"), "id", "h", prefix, at_most).collect()
    want = {(a, b, distance(x, y)) for (a, x), (b, y) in itertools.combinations(enumerate(hashes), 2) if x[:prefix] == y[:prefix] and distance(x, y) <= at_most} | {(1000, 1001, 0)}
    assert {tuple(r) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("prefix,at_most", [(4, 5), (1, 20), (0, 8)])
def test_leaders_against_the_walk(spark, prefix, at_most):
    rng = random.Random(prefix)
    hashes = likely_near(rng, 400, at_most + 1)
    rows = [(f"{rng.randrange(10**6):06d}-{i}", h) for i, h in enumerate(hashes + hashes[:50])]
    got = dedup.leaders(spark.createDataFrame([*rows, ("bad", "xyz"), ("none", None)], "id string, h string"), "id", "h", prefix, at_most)
    assert sorted(map(tuple, got.collect())) == plain_leaders(rows, prefix, at_most)
    assert dedup.leaders(spark.createDataFrame([], "id string, h string"), "id", "h").count() == 0


def test_a_chain_in_order_of_ids(spark):
    """Each row is near to the one before it and the one behind it only: every second leads."""
    x, rows = 0, []
    for i in range(12):
        rows.append((f"{i:02d}", f"{x:016x}"))
        x ^= 0b11111 << (4 * i)
    assert sorted(map(tuple, dedup.leaders(spark.createDataFrame(rows, "id string, h string"), "id", "h", 0, 5).collect())) == plain_leaders(rows, 0, 5)


def test_one_bucket_of_many_rows(spark):
    """200,000 rows of one bucket, half of them of one hash: no task gets the bucket, and no pairs of equal hashes are made."""
    rows = spark.range(200_000).select(
        F.format_string("%07d", "id").alias("id"),
        F.when(F.col("id") % 2 == 0, F.lit("abcd000000000000")).otherwise(F.concat(F.lit("abcd"), F.substr(F.sha2((F.floor(F.col("id") / 6)).cast("string"), 256), F.lit(1), F.lit(11)), F.hex(F.col("id") % 4))).alias("h"),
    )
    rows = rows.withColumn("h", F.lower("h"))
    found = dedup.leaders(rows, "id", "h")
    assert found.count() == 200_000
    sizes = {r["group_id"]: r["count"] for r in found.groupBy("group_id").count().collect()}
    assert sizes["near_abcd00000000"] == 100_000 and 33_000 < len(sizes) <= 33_400
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_no_side_of_a_join_goes_through_the_driver(spark):
    """Rows are multiplied before they meet, which Spark's guess of their size doesn't see: it sent all keys of all rows to the driver."""
    hashes = spark.range(300).select("id", F.substr(F.md5(F.col("id").cast("string").cast("binary")), F.lit(1), F.lit(16)).alias("hash"))
    for found in (dedup.similar_pairs(hashes, "id", "hash", 2, 24), dedup.leaders(hashes, "id", "hash", 2, 24)):
        assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()
