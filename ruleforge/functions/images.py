"""Perceptual hashes and blank checks of images as NumPy arrays. Resampling is by area means, so hashes need not equal an imaging library's."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd

# Hash side, oversampling, bits that may differ, least grey deviation, most similarity to white.
HASH_SIDE, OVERSAMPLE, MAX_DISTANCE, MIN_DEVIATION, MAX_WHITE = 16, 4, 2, 2.0, 0.99


def gray(pixels: np.ndarray) -> np.ndarray:
    """Luma of an (h, w), (h, w, 3) or (h, w, 4) array; transparency over white."""
    x = np.asarray(pixels, float)
    if x.ndim == 2:
        return x
    if x.shape[2] == 4:
        a = x[..., 3:] / 255
        x = x[..., :3] * a + 255 * (1 - a)
    return x[..., :3] @ np.array([0.299, 0.587, 0.114])


@lru_cache(256)
def _weights(size: int, to: int) -> np.ndarray:
    """How much each of ``size`` cells counts in each of ``to`` equal stretches."""
    edge = np.linspace(0, size, to + 1)
    lo, hi = np.maximum(edge[:-1, None], np.arange(size)), np.minimum(edge[1:, None], np.arange(size) + 1)
    return np.maximum(hi - lo, 0) * (to / size)


def resized(x: np.ndarray, h: int, w: int) -> np.ndarray:
    return _weights(x.shape[0], h) @ x @ _weights(x.shape[1], w).T


@lru_cache(64)
def _basis(n: int) -> np.ndarray:
    k = np.arange(n)
    return np.cos(np.pi * k[:, None] * (2 * k[None] + 1) / (2 * n)) * 2


def dct2(x: np.ndarray) -> np.ndarray:
    return _basis(x.shape[0]) @ x @ _basis(x.shape[1]).T


def phash(pixels: np.ndarray, side: int = HASH_SIDE) -> list[int]:
    """The hash as longs of 64 bits: which low frequencies lie above their median."""
    n = side * OVERSAMPLE
    low = dct2(resized(gray(pixels), n, n))[:side, :side]
    return np.packbits((low > np.median(low)).ravel()).view(">i8").astype(np.int64).tolist()


def _window_sums(x: np.ndarray, window: int) -> np.ndarray:
    """Sums over all squares of ``window`` cells a side: first over rows, then over columns, so a cell is added 2 * window times and not window ** 2 times."""
    rows = sum(x[i : len(x) - window + 1 + i] for i in range(window))
    return sum(rows[:, i : x.shape[1] - window + 1 + i] for i in range(window))


def similarity_to_white(pixels: np.ndarray, side: int = 256, window: int = 7) -> float:
    """Mean structural similarity to a white image of the same size, by uniform windows."""
    x = resized(gray(pixels), side, side)
    c1, c2, white, n = (0.01 * 255) ** 2, (0.03 * 255) ** 2, 255.0, window**2
    middle = x.mean()  # variances are of differences from it, so that little cancels
    off = _window_sums(x - middle, window) / n
    mean, var = off + middle, np.maximum(_window_sums((x - middle) ** 2, window) / n - off**2, 0) * n / (n - 1)
    return float((((2 * mean * white + c1) * c2) / ((mean**2 + white**2 + c1) * (var + c2))).mean())


@lru_cache(256)
def _shares(size: int, side: int, window: int) -> np.ndarray:
    """How much each of ``size`` cells counts in the mean of all windows of the resized image."""
    return np.convolve(np.ones(side - window + 1), np.ones(window)) / (window * (side - window + 1)) @ _weights(size, side)


def most_similarity_to_white(pixels: np.ndarray, side: int = 256, window: int = 7) -> float:
    """No less than similarity_to_white(), from the windows' mean alone: a window's share is its luminance term at most, which is concave in its mean."""
    x, c1, white = gray(pixels), (0.01 * 255) ** 2, 255.0
    mean = _shares(x.shape[0], side, window) @ x @ _shares(x.shape[1], side, window)
    return float((2 * mean * white + c1) / (mean**2 + white**2 + c1))


def is_blank(pixels: np.ndarray) -> bool:
    x = gray(pixels)
    return bool(x.std() < MIN_DEVIATION or most_similarity_to_white(x) > MAX_WHITE - 1e-6 and similarity_to_white(x) > MAX_WHITE)


def hashed_images(df, image: str = "pixels"):
    """Adds phash (array of longs) and blank to rows whose ``image`` is struct<h int, w int, channels int, data binary>."""
    from pyspark.sql import functions as F

    @F.pandas_udf("phash array<long>, blank boolean")
    def look(rows: pd.DataFrame) -> pd.DataFrame:
        arrays = [np.frombuffer(d, np.uint8).reshape((h, w, c) if c > 1 else (h, w)) for h, w, c, d in zip(rows["h"], rows["w"], rows["channels"], rows["data"], strict=True)]
        return pd.DataFrame({"phash": [phash(a) for a in arrays], "blank": [is_blank(a) for a in arrays]})

    return df.withColumn("_look", look(image)).withColumn("phash", F.col("_look.phash")).withColumn("blank", F.col("_look.blank")).drop("_look")


def hashed_files(df, content: str = "content"):
    """Adds height, width, phash (array of longs) and blank to rows of image files, as binaryFile reads them; all null for what can't be read.

    PNG files of any kind are read; other formats need a decoder of the user's, see looked_at().
    """
    from .png import decoded

    return looked_at(df, decoded, content)


def looked_at(df, decode, content: str = "content"):
    """As hashed_files(), with ``decode`` from bytes to an array of gray, RGB or RGBA bytes, or None."""
    from pyspark.sql import functions as F

    def one(data):
        x = decode(data)
        return (None,) * 4 if x is None else (x.shape[0], x.shape[1], phash(x), is_blank(x))

    @F.pandas_udf("height int, width int, phash array<long>, blank boolean")
    def look(files: pd.Series) -> pd.DataFrame:
        rows = [one(bytes(f)) if f is not None else (None,) * 4 for f in files]
        out = pd.DataFrame(rows, columns=["height", "width", "phash", "blank"], dtype=object)
        return out.astype({"height": "Int32", "width": "Int32"})

    return df.withColumn("_look", look(content)).select(*(c for c in df.columns if c not in ("height", "width", "phash", "blank")), "_look.*")
