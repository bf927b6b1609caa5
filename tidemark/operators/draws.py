"""Random counts and order statistics drawn from hashes, so that no draw needs the rows it stands for.

A draw depends only on its seed and key: the same on every run, partitioning and engine.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import seeded_uniform

GAMMA_TRIES = 32  # each is taken with at least 0.95


def gamma_draws(keys: DataFrame, key: str, shape: float, seed: int, part: str) -> DataFrame:
    """``(key, g)``: one gamma variate of shape 1 or more a key, by Marsaglia and Tsang (2000).

    All tries of a key are rows of their own, the first accepted one stays.
    """
    d = shape - 1.0 / 3.0
    c = 1.0 / math.sqrt(9.0 * d)
    tries = keys.select(key, F.explode(F.sequence(F.lit(0), F.lit(GAMMA_TRIES - 1))).alias("try"))
    u = lambda name: seeded_uniform(seed, F.lit(part + name), key, "try")
    normal = F.sqrt(F.log(F.lit(1.0) - u("1")) * -2.0) * F.cos(u("2") * (2.0 * math.pi))
    drawn = tries.select(key, "try", normal.alias("x"), (F.lit(1.0) - u("3")).alias("w"))
    cubed = drawn.withColumn("v", F.pow(F.col("x") * c + 1.0, F.lit(3.0)))
    taken = cubed.where((F.col("v") > 0) & (F.log("w") < F.col("x") * F.col("x") * 0.5 + d - F.col("v") * d + F.log("v") * d))
    return taken.groupBy(key).agg((F.min_by("v", "try") * d).alias("g"))


def order_statistics(keys: DataFrame, key: str, n: int, lo: int, hi: int, seed: int) -> DataFrame:
    """``(key, lo, hi)``: what stands at ranks ``lo`` and ``hi`` (``lo`` or the next) of n draws from ``0 .. n - 1``.

    With replacement and from 0. The k-th smallest of n uniform numbers follows the beta law (k, n - k + 1), and the part
    above it that the next one leaves free is a power of a uniform number, so two variates stand for n draws.
    """
    k = lo + 1
    a, b = gamma_draws(keys, key, float(k), seed, "a"), gamma_draws(keys, key, float(n - k + 1), seed, "b")
    first = F.col("a.g") / (F.col("a.g") + F.col("b.g"))
    both = a.alias("a").join(b.alias("b"), key).select(key, first.alias("u"))
    if hi > lo:
        free = F.pow(F.lit(1.0) - seeded_uniform(seed, F.lit("next"), key), F.lit(1.0 / (n - k)))
        both = both.withColumn("w", F.lit(1.0) - (F.lit(1.0) - F.col("u")) * free)
    else:
        both = both.withColumn("w", F.col("u"))
    place = lambda c: F.least(F.lit(n - 1), F.floor(F.col(c) * n)).cast("bigint")
    return both.select(key, place("u").alias("lo"), place("w").alias("hi"))


def log_factorial(x: np.ndarray) -> np.ndarray:
    """ln x! by Stirling's series eight places further up."""
    z = x + 1.0
    s = z + 8.0
    product = z.copy()
    for i in range(1, 8):
        product *= z + float(i)
    return (s - 0.5) * np.log(s) - s + 0.9189385332046727 + 1 / (s * 12) - 1 / (s**3 * 360) + 1 / (s**5 * 1260) - 1 / (s**7 * 1680) - np.log(product)


def log_choose(n: np.ndarray, k: np.ndarray) -> np.ndarray:
    return log_factorial(n) - log_factorial(k) - log_factorial(n - k)


def _two_uniforms(text: str) -> tuple[float, float]:
    digest = hashlib.md5(text.encode()).hexdigest()
    return int(digest[:13], 16) / 2.0**52, int(digest[13:26], 16) / 2.0**52


def draw_counts(n: np.ndarray, k: np.ndarray, c: np.ndarray, keys: list[str]) -> np.ndarray:
    """How many of ``c`` taken from ``n`` fall among ``k`` of them, one draw a key.

    Ratio of uniforms for a log-concave law with mode m: the histogram of f lies within heights up to root f(m) and
    widths up to 1 / root f(m) on both sides, because a log-concave run between m and k holds at least the geometric
    mean of its ends on average. So one rule covers every size, and a try is taken with 1/4.
    """
    log_f = lambda at, x: log_choose(k[at], x) + log_choose(n[at] - k[at], c[at] - x)
    low, high = np.maximum(0.0, c - (n - k)), np.minimum(c, k)
    mode = np.clip(np.floor((c + 1.0) * (k + 1.0) / (n + 2.0)), low, high)
    every = np.arange(len(n))
    top = log_f(every, mode)
    peak = np.exp(top - log_choose(n, c))
    out, open_ = low.copy(), np.flatnonzero(low < high)
    attempt = 0
    while len(open_):
        pairs = np.array([_two_uniforms(f"{keys[i]}-{attempt}") for i in open_])
        u, v = 1.0 - pairs[:, 0], pairs[:, 1] * 2.0 - 1.0
        x = np.floor(mode[open_] + v / (u * peak[open_]))
        inside = (x >= low[open_]) & (x <= high[open_])
        tried = np.where(inside, x, mode[open_])
        taken = inside & (log_f(open_, tried) - top[open_] >= 2.0 * np.log(u))
        out[open_[taken]] = x[taken]
        open_ = open_[~taken]
        attempt += 1
    return out


def hypergeometric(df: DataFrame, total: str, left: str, drawn: str, name: str, seed: int, *key: str | Column) -> DataFrame:
    """Add how many of ``drawn`` rows taken from ``total`` fall among ``left`` of them, without replacement.

    Tries differ in number from row to row, so they are made in Arrow batches, each for the rows still open.
    """
    text = F.concat_ws("-", F.lit(str(seed)), *[(F.col(x) if isinstance(x, str) else x).cast("string") for x in key])

    @F.pandas_udf("bigint")
    def drawn_of(n: pd.Series, k: pd.Series, c: pd.Series, keys: pd.Series) -> pd.Series:
        numbers = (x.to_numpy(dtype=np.float64, copy=True) for x in (n, k, c))
        return pd.Series(draw_counts(*numbers, keys.tolist()).astype(np.int64))

    return df.withColumn(name, drawn_of(total, left, drawn, text))
