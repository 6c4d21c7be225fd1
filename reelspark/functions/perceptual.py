"""Perceptual hashes of grey frames, in batches."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIDE, KEPT, FRAMES = 32, 8, 5


def cosine_basis(n: int = SIDE) -> np.ndarray:
    """The orthonormal DCT-II of n points, a row for each frequency."""
    places = np.arange(n)
    basis = np.sqrt(2 / n) * np.cos(np.pi * np.outer(places, 2 * places + 1) / (2 * n))
    basis[0] = np.sqrt(1 / n)
    return basis


def hashes(frames: np.ndarray) -> np.ndarray:
    """64-bit hashes (as signed numbers) of (n, SIDE, SIDE) frames.

    A bit is set where a low frequency is above the median of all but the first of
    them; the first one, mean brightness, has a bit itself, the highest.
    """
    if not len(frames):
        return np.zeros(0, np.int64)
    low = cosine_basis()[:KEPT]
    block = (low @ frames.astype(np.float64) @ low.T).reshape(len(frames), -1)
    return np.packbits(block > np.median(block[:, 1:], axis=1)[:, None], axis=1).view(">u8").astype(np.uint64).view(np.int64).reshape(-1)


def signature(frames: list[bytes], n: int = FRAMES) -> list[int]:
    """n hashes of a clip's frames: the last one repeats where frames lack; zeros without any."""
    found = hashes(np.stack([np.frombuffer(f, np.uint8).reshape(SIDE, SIDE) for f in frames])).tolist() if frames else [0]
    return (found + found[-1:] * n)[:n]


@F.pandas_udf(T.ArrayType(T.LongType()))
def signatures(frames: pd.Series) -> pd.Series:
    """Signatures of clips, each an array of SIDE * SIDE grey bytes for a frame."""
    return frames.map(lambda x: signature(list(x) if x is not None else []))


def hex_of(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def distance(a: Column, b: Column, n: int = FRAMES) -> Column:
    """Differing bits of two signatures of n hashes."""
    total = F.lit(0)
    for i in range(n):
        total = total + F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i))))
    return total
