"""What images say about themselves, and features of decoded pixels. No image library is needed."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions import hashing


def size_of_image(raw: bytes | None) -> tuple[int, int] | None:
    """Width and height from the header of a PNG, JPEG, BMP, GIF or WebP file; None if it can't be read."""
    if not raw or len(raw) < 10:
        return None
    try:
        if raw[:8] == b"\x89PNG\r\n\x1a\n" and raw[12:16] == b"IHDR":
            found = struct.unpack(">II", raw[16:24])
        elif raw[:2] == b"BM":
            width, height = struct.unpack("<ii", raw[18:26])
            found = width, abs(height)
        elif raw[:6] in (b"GIF87a", b"GIF89a"):
            found = struct.unpack("<HH", raw[6:10])
        elif raw[:4] == b"RIFF" and raw[8:12] == b"WEBP":
            found = _webp(raw)
        elif raw[:2] == b"\xff\xd8":
            found = _jpeg(raw)
        else:
            return None
    except (struct.error, IndexError):
        return None
    return found if found and min(found) > 0 else None


def _webp(raw: bytes) -> tuple[int, int] | None:
    kind = raw[12:16]
    if kind == b"VP8X":
        return 1 + int.from_bytes(raw[24:27], "little"), 1 + int.from_bytes(raw[27:30], "little")
    if kind == b"VP8L":
        bits = struct.unpack("<I", raw[21:25])[0]
        return 1 + (bits & 0x3FFF), 1 + (bits >> 14 & 0x3FFF)
    if kind == b"VP8 ":
        width, height = struct.unpack("<HH", raw[26:30])
        return width & 0x3FFF, height & 0x3FFF
    return None


def _jpeg(raw: bytes) -> tuple[int, int] | None:
    at = 2
    while at + 9 < len(raw):
        if raw[at] != 0xFF:
            return None
        marker = raw[at + 1]
        if marker == 0xFF:  # padding
            at += 1
        elif 0xC0 <= marker <= 0xCF and marker not in (0xC4, 0xC8, 0xCC):
            height, width = struct.unpack(">HH", raw[at + 5 : at + 9])
            return width, height
        elif 0xD0 <= marker <= 0xD8 or marker == 0x01:
            at += 2
        else:
            at += 2 + struct.unpack(">H", raw[at + 2 : at + 4])[0]
    return None


def image_size(content: Column) -> Column:
    """struct(width, height) of image files; both null for what can't be read. Arrow batches of binary columns."""

    @F.pandas_udf("width int, height int")
    def sizes(column: pd.Series) -> pd.DataFrame:
        found = [size_of_image(raw) or (None, None) for raw in column]
        return pd.DataFrame(found, columns=["width", "height"], dtype="Int32")

    return sizes(content)


def resized(pixels: np.ndarray, side: int) -> np.ndarray:
    """Pixels (height, width, channels) averaged over a grid of side x side cells; smaller images repeat their pixels."""
    rows, columns = (np.linspace(0, n, side + 1) for n in pixels.shape[:2])
    sums = np.zeros((pixels.shape[0] + 1, pixels.shape[1] + 1, pixels.shape[2]))
    sums[1:, 1:] = pixels.astype(np.float64).cumsum(axis=0).cumsum(axis=1)
    r0, c0 = np.floor(rows[:-1]).astype(int), np.floor(columns[:-1]).astype(int)
    r1, c1 = np.maximum(r0 + 1, np.ceil(rows[1:]).astype(int)), np.maximum(c0 + 1, np.ceil(columns[1:]).astype(int))
    area = ((r1 - r0)[:, None] * (c1 - c0)[None, :])[:, :, None]
    return (sums[r1][:, c1] - sums[r0][:, c1] - sums[r1][:, c0] + sums[r0][:, c0]) / area


def _cubic(x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    return np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0.0))


def _lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0.0)


#: Kernels by name: how far they reach, and their value at a distance.
KERNELS = {"triangle": (1.0, lambda x: np.maximum(0.0, 1 - np.abs(x))), "cubic": (2.0, _cubic), "lanczos": (3.0, _lanczos)}
#: Weights are whole multiples of 2**-22, as usual for pixels of eight bits.
_ONE = 1 << 22


def weights(old: int, new: int, kernel: str = "cubic") -> np.ndarray:
    """(new, old): the weight of each old pixel in each new one along an axis, in multiples of 2**-22.

    Where an axis shrinks the kernel is as much wider as it has to be to look at all pixels; beyond the border there is nothing.
    """
    reach, value = KERNELS[kernel]
    scale = old / new
    wide = max(1.0, scale)
    center = (np.arange(new)[:, None] + 0.5) * scale
    at = np.arange(old)[None, :]
    inside = (at >= np.maximum(0, np.trunc(center - reach * wide + 0.5))) & (at < np.minimum(old, np.trunc(center + reach * wide + 0.5)))
    w = np.where(inside, value((at - center + 0.5) / wide), 0.0)
    w = w / w.sum(axis=1, keepdims=True)
    return np.trunc(w * _ONE + np.where(w < 0, -0.5, 0.5))


def resampled(pixels: np.ndarray, height: int, width: int, kernel: str = "cubic") -> np.ndarray:
    """Pixels of eight bits (height, width, channels) in another size: along rows first, then along columns, each rounded to eight bits."""
    out = pixels.astype(np.float64)  # exact: sums stay below 2**53
    for axis, new in ((1, width), (0, height)):
        w = weights(out.shape[axis], new, kernel)
        out = np.moveaxis(np.tensordot(out, w, axes=([axis], [1])), -1, axis)
        out = np.clip(np.floor((out + _ONE / 2) / _ONE), 0, 255)
    return out.astype(np.uint8)


def grey(pixels: np.ndarray) -> np.ndarray:
    """(height, width, 1) of pixels stored blue, green, red, or grey already."""
    if pixels.shape[2] == 1:
        return pixels
    blue, green, red = (pixels[:, :, i].astype(np.int64) for i in range(3))
    return ((19595 * red + 38470 * green + 7471 * blue + 32768) >> 16).astype(np.uint8)[:, :, None]


def decoded(height: int | None, width: int | None, channels: int | None, data: bytes | None) -> np.ndarray | None:
    """The pixels of Spark's image struct, or None if there are none."""
    if data is None or not height or not width or height <= 0 or width <= 0 or channels not in (1, 3, 4) or len(data) != height * width * channels:
        return None
    return np.frombuffer(data, dtype=np.uint8).reshape(int(height), int(width), int(channels))


def grey_cells(image: Column, side: int = 8, kernel: str = "cubic") -> Column:
    """The grey values of an image (Spark's struct) resampled to side x side cells, row by row; null for what can't be decoded."""

    @F.pandas_udf("array<int>")
    def cells(rows: pd.DataFrame) -> pd.Series:
        found = [decoded(*x) for x in zip(rows["h"], rows["w"], rows["n"], rows["data"], strict=True)]
        out = [None if p is None else resampled(grey(p), side, side, kernel).ravel().astype(np.int32) for p in found]
        return pd.Series(out, dtype=object)

    at = lambda c, kind: F.coalesce(image[c], F.lit(0)).cast(kind)
    return cells(F.struct(at("height", "int").alias("h"), at("width", "int").alias("w"), at("nChannels", "int").alias("n"), image["data"].alias("data")))


def average_hashes(images: DataFrame, image: str, sha1: str, out: str = "hash") -> DataFrame:
    """images with 16 hexadecimal digits of each: which of 8 x 8 grey cells are at least their mean.

    An image that can't be decoded has the first 16 digits of its content's hash.
    """
    cells = images.withColumn("__cells", grey_cells(F.col(image)))
    return cells.withColumn(out, F.coalesce(hashing.mean_hash(F.col("__cells")), F.substr(sha1, F.lit(1), F.lit(16)))).drop("__cells")


def features(images: DataFrame, side: int = 48) -> DataFrame:
    """images, without ``image`` (height, width, nChannels, data: what Spark's image source gives), with ``features``.

    Features are the red, green and blue values, from 0 to 1, of the image resampled to side x side, row by row. Images
    that can't be decoded are left out.
    """
    others = [c for c in images.columns if c != "image"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out, keep = [], []
            for i, (h, w, n, data) in enumerate(zip(rows["__h"], rows["__w"], rows["__n"], rows["__data"], strict=True)):
                pixels = decoded(h, w, n, data)
                if pixels is None:
                    continue
                pixels = np.repeat(pixels, 3, axis=2) if n == 1 else pixels[:, :, 2::-1]  # stored blue first
                out.append((resampled(pixels, side, side) / np.float32(255)).ravel().astype(np.float32))
                keep.append(i)
            found = rows.iloc[keep][others]
            yield found.assign(features=pd.Series(out, index=found.index, dtype=object))  # also if there is none

    at = images.select(*others, F.col("image.height").alias("__h"), F.col("image.width").alias("__w"), F.col("image.nChannels").alias("__n"), F.col("image.data").alias("__data"))
    schema = images.select(*others).schema.add("features", T.ArrayType(T.FloatType()))
    return at.where("__data is not null").mapInPandas(run, schema)
