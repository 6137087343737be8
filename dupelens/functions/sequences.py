"""Fingerprint sequences: how they are built from content and compared."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_OFFSET = 120
WORD_BITS = 32
NEAR = 12
_BLOCK = 4_000_000


def tokens(text: Column | str) -> Column:
    """Lower-cased blank-separated tokens of the whole text."""
    return F.split(F.lower(text), " ")


def token_value(token: Column) -> Column:
    """Non-negative 32-bit value of a token: the first eight hex digits of its MD5."""
    return F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("bigint")


def token_values(text: Column | str) -> Column:
    """32-bit value sequence of the whole text."""
    return F.transform(tokens(text), token_value)


def token_hashes(text: Column | str) -> Column:
    """64-bit value sequence, cheaper to compute than :func:`token_values`; for scoring."""
    return F.transform(tokens(text), lambda token: F.xxhash64(token))


def sign_word(vector: Column | str) -> Column:
    """64-bit word with bit i set where component i is not negative."""
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    bits = F.transform(vector, lambda v, i: F.when(v >= 0, F.call_function("shiftleft", one, i)).otherwise(none))
    return F.aggregate(bits, none, lambda word, bit: word.bitwiseOR(bit))


def _best_alignment(a: np.ndarray, b: np.ndarray, max_offset: int, max_bits: int = 0) -> float:
    """Matches at the best relative offset, divided by the shorter length."""
    if len(a) > len(b):
        a, b = b, a
    n, reach = len(a), max_offset
    padded = np.zeros(len(b) + 2 * reach, dtype=np.int64)
    padded[reach : reach + len(b)] = b
    inside = np.zeros(len(padded), dtype=bool)
    inside[reach : reach + len(b)] = True
    if not max_bits:
        # The padding must match nothing in `a`: any value that `a` lacks will do.
        filler = np.int64(0)
        while (a == filler).any():
            filler += 1
        padded[~inside] = filler
    windows = np.lib.stride_tricks.sliding_window_view(padded, n)[: 2 * reach + 1]
    valid = np.lib.stride_tricks.sliding_window_view(inside, n)[: 2 * reach + 1]
    step = max(1, _BLOCK // n)
    # Small offsets first: nothing is better than a match of all places, and that is found there most often.
    near, above = max(0, reach - NEAR), min(len(windows), reach + NEAR + 1)
    best = 0
    for first, end in ((near, above), (0, near), (above, len(windows))):
        for low in range(first, end, step):
            part = windows[low : min(end, low + step)]
            if max_bits:
                equal = (np.bitwise_count(part ^ a) <= max_bits) & valid[low : low + len(part)]
            else:
                equal = part == a
            best = max(best, int(equal.sum(axis=1).max()))
            if best == n:
                return 1.0
    return best / n


def best_alignment(max_offset: int = MAX_OFFSET, max_bits: int = 0):
    """Vectorised scorer of two sequence columns: similarity in [0, 1], null for a missing or empty one.

    score = max over offsets o, |o| <= max_offset, of #{i : a[i + o] matches b[i]} / min(length); two values match if at most
    ``max_bits`` of their bits differ. Work per pair is bounded by (2 max_offset + 1) * length however often a value
    repeats, which a join of the positions is not. Built-in array functions can express it but evaluate lambda by lambda,
    about 50 times slower.
    """

    @F.pandas_udf("double")
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series(
            [
                None if a is None or b is None or len(a) == 0 or len(b) == 0
                else _best_alignment(np.asarray(a), np.asarray(b), max_offset, max_bits)
                for a, b in zip(left, right)
            ],
            dtype="float64",
        )

    # Keeps the optimizer from evaluating it once more below a filter on the score.
    return score.asNondeterministic()


def bit_differences(a: Column | str, b: Column | str) -> Column:
    """Positional comparison of two 32-bit sequences over their common length, as one struct."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    shared = F.least(F.size(a), F.size(b))
    bits = F.zip_with(
        F.slice(a, 1, shared), F.slice(b, 1, shared), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")
    )
    return F.struct(shared.alias("shared"), F.greatest(F.size(a), F.size(b)).alias("longest"), bits.alias("bits"))


def bit_diff_columns(diff: Column | str) -> list[Column]:
    """Statistics of a :func:`bit_differences` struct column."""
    diff = F.col(diff) if isinstance(diff, str) else diff
    shared, longest, bits = diff["shared"], diff["longest"], diff["bits"]
    differing = F.size(F.filter(bits, lambda x: x > 0))
    total = F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, x: acc + x)
    positions = F.filter(
        F.transform(bits, lambda x, i: F.when(x > 0, i)), lambda x: x.isNotNull()
    )
    return [
        shared.alias("min_length"),
        longest.alias("max_length"),
        (longest - shared).alias("length_difference"),
        (shared - differing).alias("matching_values"),
        differing.alias("different_values"),
        ((shared - differing) / shared).alias("value_match_ratio"),
        (1 - total / (shared * F.lit(WORD_BITS))).alias("bit_similarity"),
        total.alias("total_bit_differences"),
        F.coalesce(F.try_divide(total, differing), F.lit(0.0)).alias("avg_bit_differences_per_value"),
        F.array_join(F.slice(positions, 1, 10), ",").alias("first_10_differences"),
    ]


def signal_metrics(pairs: DataFrame, keys: list[str], a: str, b: str, audible: float = 0.01, same: float = 1e-4) -> DataFrame:
    """Correlation, largest difference and first differing position of two signals per pair.

    Positions are matched over the shorter length. Each pair's samples sit in one input row, so they are
    aggregated before the shuffle.
    """
    shared = F.least(F.size(a), F.size(b))
    samples = F.arrays_zip(F.slice(a, 1, shared).alias("x"), F.slice(b, 1, shared).alias("y"))
    gap = F.abs(F.col("s.x").cast("double") - F.col("s.y").cast("double"))
    return (
        pairs.select(*keys, F.posexplode(samples).alias("pos", "s"))
        .select(*keys, "pos", F.col("s.x").cast("double").alias("x"), F.col("s.y").cast("double").alias("y"), gap.alias("gap"))
        .groupBy(*keys)
        .agg(
            F.count(F.lit(1)).alias("shared_length"),
            F.min(F.when(F.col("gap") > audible, F.col("pos"))).alias("first_difference"),
            F.round(F.corr("x", "y"), 6).alias("correlation"),
            F.round(F.max("gap"), 6).alias("max_difference"),
            F.when(F.max("gap") < same, "IDENTICAL").otherwise("DIFFERENT").alias("verdict"),
        )
    )
