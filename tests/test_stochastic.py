"""Stochastic steps on the logistic loss: equal to a plain version, whatever the partitions."""

import hashlib
import math

import numpy as np

from granary.operators import learning

ROW = "id long, features array<float>, label string"


def plain(rows, epochs, block_rows, ridge=1e-5, rate=0.5, power=0.25, seed=42):
    """Row by row, class by class, feature by feature."""
    rows = [r for r in rows if r[1] is not None and r[2] is not None]
    classes, d, n = sorted({r[2] for r in rows}), len(rows[0][1]), len(rows)
    x = np.array([r[1] for r in rows], dtype=np.float32).astype(float)
    scale = x.std(axis=0)
    scale[scale == 0] = 1
    blocks = {}
    for r, own in zip(rows, x / scale, strict=True):
        digest = hashlib.sha1(f"{seed}:{r[0]}".encode()).hexdigest()
        blocks.setdefault(int(digest[:12], 16) % max(1, -(-n // block_rows)), []).append((digest, str(r[0]), own, r[2]))
    common = [[0.0] * (d + 1) for _ in classes]
    for epoch in range(epochs):
        total = [[0.0] * (d + 1) for _ in classes]
        for block in blocks.values():
            w = [list(c) for c in common]
            for i, (_, _, own, label) in enumerate(sorted(block, key=lambda b: b[:2])):
                pace = rate / (1 + epoch * block_rows + i) ** power
                for c, name in enumerate(classes):
                    miss = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(w[c], own)) + w[c][d]))) - (label == name)
                    w[c] = [a * (1 - pace * ridge) - pace * miss * b for a, b in zip(w[c][:d], own)] + [w[c][d] - pace * miss]
            for c in range(len(classes)):
                for j in range(d + 1):
                    total[c][j] += w[c][j] * len(block) / n
        common = total
    return classes, np.array(common), scale


def test_against_a_plain_version(spark):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(3, 6)) * 2
    rows = [(i, [float(v) for v in centers[i % 3] + rng.normal(size=6)] + [1.0], "abc"[i % 3]) for i in range(300)] + [(900, None, "a"), (901, [0.0] * 7, None)]
    want = plain(rows, 4, 64)
    table = spark.createDataFrame(rows, ROW)
    for parts in (1, 7):
        got = learning.train_stochastic(table.repartition(parts), "id", epochs=4, block_rows=64)
        assert got.classes == want[0] and np.abs(got.weights - want[1]).max() < 1e-6 and np.abs(got.scale - want[2]).max() < 1e-9
    found = learning.predicted_linear(got, table).collect()
    assert sum(r["predicted"] == r["label"] for r in found if r["id"] < 900) >= 270 and {r["predicted"] for r in found if r["id"] == 900} == {None}


def test_no_rows_and_one_class(spark):
    table = spark.createDataFrame([(1, [1.0, 2.0], "x"), (2, [1.0, 3.0], "x")], ROW)
    empty = learning.train_stochastic(table.where("false"), "id")
    assert empty.classes == [] and {r["predicted"] for r in learning.predicted_linear(empty, table).collect()} == {None}
    one = learning.train_stochastic(table, "id", epochs=1)
    assert {r["predicted"] for r in learning.predicted_linear(one, table).collect()} == {"x"}
