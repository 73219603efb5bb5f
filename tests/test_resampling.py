"""Resampling by kernels, and what is made of it: against weights worked out by hand and a plain version."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from granary.functions import pixels


def test_weights_by_hand():
    """Twice as small: the triangle weighs 1, 3, 3, 1 eighths, at the border 3, 3, 1 sevenths; the cubic -3, -9, 29, 111 of 256 and back, at half steps."""
    one = 1 << 22
    w = pixels.weights(8, 4, "triangle")
    assert w[1].tolist() == [0, *[int(x * one + 0.5) for x in (1 / 8, 3 / 8, 3 / 8, 1 / 8)], 0, 0, 0]
    assert w[0].tolist() == [int(x * one + 0.5) for x in (3 / 7, 3 / 7, 1 / 7)] + [0] * 5
    cubic = [-0.5 * 1.75**3 + 2.5 * 1.75**2 - 4 * 1.75 + 2, -0.5 * 1.25**3 + 2.5 * 1.25**2 - 4 * 1.25 + 2, 1.5 * 0.75**3 - 2.5 * 0.75**2 + 1, 1.5 * 0.25**3 - 2.5 * 0.25**2 + 1]
    assert abs(2 * sum(cubic) - 2) < 1e-12
    assert pixels.weights(16, 8)[4].tolist() == [0] * 5 + [math.trunc(x / 2 * one + (0.5 if x > 0 else -0.5)) for x in [*cubic, *cubic[::-1]]] + [0] * 3
    assert (pixels.weights(5, 5) == np.eye(5) * one).all() and (pixels.weights(1, 3) == one).all()


def plain(image, height, width, kernel):
    """One pixel after the other."""
    reach, value = pixels.KERNELS[kernel]

    def along(line, new):
        scale, out = len(line) / new, []
        wide = max(1.0, scale)
        for o in range(new):
            center = (o + 0.5) * scale
            lo, hi = max(0, int(center - reach * wide + 0.5)), min(len(line), int(center + reach * wide + 0.5))
            w = [float(value(np.array((i - center + 0.5) / wide))) for i in range(lo, hi)]
            fixed = [int(x / sum(w) * (1 << 22) + (0.5 if x >= 0 else -0.5)) for x in w]
            out.append(min(255, max(0, (sum(int(p) * k for p, k in zip(line[lo:hi], fixed, strict=True)) + (1 << 21)) >> 22)))
        return out

    rows = [along(r, width) for r in image.tolist()]
    columns = [along([r[x] for r in rows], height) for x in range(width)]
    return np.array(columns).T


@pytest.mark.parametrize("kernel", sorted(pixels.KERNELS))
@pytest.mark.parametrize("shape,new", [((31, 17), (8, 8)), ((3, 40), (8, 8)), ((1, 1), (4, 2)), ((8, 8), (8, 8)), ((2, 5), (7, 48))])
def test_against_a_plain_version(kernel, shape, new):
    image = np.random.default_rng(3).integers(0, 256, shape).astype(np.uint8)
    assert (pixels.resampled(image[:, :, None], *new, kernel)[:, :, 0] == plain(image, *new, kernel)).all()


def test_hashes_of_images(spark):
    rng = np.random.default_rng(1)
    shapes = [(9, 20, 3), (8, 8, 1), (30, 7, 4), (1, 1, 3)]
    rows, want = [], []
    for i, shape in enumerate(shapes):
        image = rng.integers(0, 256, shape).astype(np.uint8)
        rows.append((i, (shape[0], shape[1], shape[2], bytearray(image.tobytes()))))
        grey = image[:, :, 0].astype(int) if shape[2] == 1 else (19595 * image[:, :, 2].astype(int) + 38470 * image[:, :, 1].astype(int) + 7471 * image[:, :, 0].astype(int) + 32768) >> 16
        cells = plain(grey.astype(np.uint8), 8, 8, "cubic").ravel()
        want.append(f"{int(''.join('1' if 64 * int(c) >= int(cells.sum()) else '0' for c in cells), 2):016x}")
    bad = [(10, (2, 2, 1, bytearray(b"abc"))), (11, (0, 0, 0, None)), (12, None), (13, (-1, -1, -1, bytearray()))]
    table = spark.createDataFrame(rows + bad, "i int, image struct<height:int,width:int,nChannels:int,data:binary>")
    table = table.withColumn("sha1", F.sha1(F.col("i").cast("string").cast("binary")))
    got = {r["i"]: r["hash"] for r in pixels.average_hashes(table.repartition(8, "i"), "image", "sha1").collect()}
    assert [got[i] for i in range(4)] == want
    assert all(got[i] == hashlib.sha1(str(i).encode()).hexdigest()[:16] for i, _ in bad)
    assert table.where("i > 9").select(pixels.grey_cells(F.col("image")).alias("c")).where("c is not null").count() == 0
