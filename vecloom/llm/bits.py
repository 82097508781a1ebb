"""A bit filter of hashed keys, of bounded size, that tasks ask before they emit rows.

A key that was put in always passes. A filter that is too full for its keys lets others pass
as well; what asks it therefore always has an exact join behind it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits at most, so 8 MB; and bits for each key below that.
MOST_BITS, BITS_A_KEY = 1 << 26, 64


def bit_filter(keys: DataFrame, name: str) -> np.ndarray:
    """The filter of a column of 64-bit hashes, as 64-bit words; its size follows the number of keys."""
    count = keys.count()
    bits = min(MOST_BITS, max(1 << 12, 1 << (count * BITS_A_KEY).bit_length()))
    place = F.col(name).bitwiseAND(F.lit(bits - 1))
    mask = F.expr(f"shiftleft(1L, cast(`{name}` & 63 as int))")
    found = keys.groupBy(F.shiftright(place, 6).alias("word")).agg(F.bit_or(mask).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.uint64)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().view(np.uint64)
    return out


def passes(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether each hash may be among the keys."""
    place = hashes.view(np.uint64) & np.uint64(len(words) * 64 - 1)
    return ((words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
