"""Hilbert curve indices of arrays of points, in numpy."""

from __future__ import annotations

import numpy as np


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of points (n, dims) with coordinates below ``2**bits``.

    dims * bits must be at most 63. The transform to transposed form exchanges or
    inverts the lower bits of the axes from the highest bit down, then takes the Gray
    code; interleaving the bits gives the index.
    """
    x = np.array(points, dtype=np.int64).T.copy()
    dims = len(x)
    if dims * bits > 63:
        raise ValueError("an index needs at most 63 bits")
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        flip ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= flip
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out
