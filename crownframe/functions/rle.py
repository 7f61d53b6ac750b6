"""Run-length masks inside one row: counts text <-> counts <-> runs.

`counts` alternates from zeros, column by column, for a mask of `size` [height, width]. A run is
`(line, c0, c1)` with `line` the column and `c0 <= row < c1`.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

def decode_text(text: str) -> list[int]:
    """Counts of a compressed counts string: 5 bits per character, differences from the third on."""
    counts: list[int] = []
    value = shift = 0
    for ch in text:
        code = ord(ch) - 48
        value |= (code & 31) << (5 * shift)
        shift += 1
        if not code & 32:
            if code & 16:
                value -= 1 << (5 * shift)
            if len(counts) > 2:
                value += counts[-2]
            counts.append(value)
            value = shift = 0
    return counts


def encode_text(counts) -> str:
    """Compressed counts string; the inverse of `decode_text`."""
    out = []
    for i, count in enumerate(counts):
        value = int(count) - (int(counts[i - 2]) if i > 2 else 0)
        while True:
            code = value & 31
            value >>= 5
            more = value != (-1 if code & 16 else 0)
            out.append(chr((code | 32 if more else code) + 48))
            if not more:
                break
    return "".join(out)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def text_to_counts(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else decode_text(t))


@F.pandas_udf(T.StringType())
def counts_to_text(counts: pd.Series) -> pd.Series:
    return counts.map(lambda c: None if c is None else encode_text(c))
