"""Vectors as exact integers: scaled and floored components, and dot products through limbs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Integers of components stay below this, so sums of many of them and their halves fit a long.
LARGEST = 1 << 62


def usable(vector: Column, scale: int) -> Column:
    """Whether a vector takes part: not null, and neither null, NaN nor infinite components, nor any whose integer needs over 62 bits."""
    below = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < F.lit(float(LARGEST // scale))))
    return vector.isNotNull() & F.coalesce(below, F.lit(False))


def longest(rows: DataFrame, vector: str) -> int:
    """The number of components of the longest vector; shorter ones count as if zeros followed."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0


def integers(column: pa.ListArray, scale: int, dim: int) -> np.ndarray:
    """floor(scale * component) of each vector as a row of ``dim`` longs."""
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _peak(a: np.ndarray) -> int:
    return max(abs(int(a.min())), abs(int(a.max()))) if a.size else 0


def _limbs(a: np.ndarray, width: int, peak: int) -> list[np.ndarray]:
    """The integers in base 2**width, lowest limb first; the top limb has the sign. Small integers are one limb."""
    count = max(1, -(-peak.bit_length() // width))
    low = [(a >> width * k) & ((1 << width) - 1) for k in range(count - 1)]
    return [x.astype(np.float64) for x in (*low, a >> width * (count - 1))]


def fits(length: int, a: int, b: int) -> bool:
    """Whether sums of ``length`` products of values up to a and b, a few times over, fit a long."""
    return max(length, 1) * a * b < 1 << 60


def limb_bits(length: int) -> int:
    """The width of limbs with which sums of ``length`` products stay below 2**53."""
    return (52 - (max(length, 1) - 1).bit_length()) // 2


class Cut:
    """Rows of longs, cut into limbs once for many exact dot products.

    Limbs are so narrow that a sum of their products stays below 2**53, where float64 matrix products are exact in any
    order of addition. The products are put together in longs, or in Python's integers if a long may not hold them.
    """

    def __init__(self, rows: np.ndarray):
        self.length, self.peak, self.width = rows.shape[1], _peak(rows), limb_bits(rows.shape[1])
        self.limbs = _limbs(rows, self.width, self.peak)

    def dot(self, other: Cut, rows: np.ndarray | slice = slice(None)) -> np.ndarray:
        """The dot products of these rows, or some of them, with all of the other's."""
        total = None
        wide = not fits(self.length, self.peak, other.peak)
        for i, x in enumerate(self.limbs):
            part = x[rows]
            for j, y in enumerate(other.limbs):
                product = (part @ y.T).astype(np.int64)
                product = product.astype(object) if wide else product
                total = product if total is None else total + (product << self.width * (i + j))
        return total


def exact_dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All dot products of the rows of ``a`` and ``b`` (longs), exactly."""
    return Cut(a).dot(Cut(b))


def squares(a: np.ndarray) -> np.ndarray:
    """The squared length of each row, as longs or as Python's integers."""
    if not fits(a.shape[1], _peak(a), _peak(a)):
        a = a.astype(object)
    return (a * a).sum(1)
