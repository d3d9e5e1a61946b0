"""String similarity: Arrow functions for the scorers Spark lacks, native expressions for the rest.

All scores lie in 0 to 1.  Two empty strings are alike (1), one empty string is unlike (0).
Scorers take lists of strings and score many pairs side by side: strings are rows of a matrix of
code points, and a step handles one character of every pair.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.normalize import tokens

#: Pairs scored side by side, and windows of them in one matrix.
SIDE, WINDOWS = 4096, 32_768
#: Characters of a string whose positions fit the bits of a word; longer ones go alone.
WORD = 64

Strings = list[str]


def _matrix(texts: Strings, width: int, pad: int) -> np.ndarray:
    """Code points, a row a string, filled up with ``pad``, which is no code point."""
    raw = np.frombuffer("".join(t.ljust(width, "\0") for t in texts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(texts), width)
    return np.where(np.arange(width) < np.array([len(t) for t in texts])[:, None], raw, np.uint32(pad))


_PADS = 0xFFFF_FFFE, 0xFFFF_FFFF


def _lcs_long(a: str, b: str) -> int:
    """Longest common subsequence, a bit a position of ``a``, in numbers of any size."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & where.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def lcs_lengths(a: Strings, b: Strings) -> np.ndarray:
    """Lengths of the longest common subsequences: each character of the longer string moves the bits of the shorter one's row."""
    pairs = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b)]
    out = np.zeros(len(pairs), dtype=np.int64)
    order = sorted((i for i, (x, _) in enumerate(pairs) if x), key=lambda i: len(pairs[i][1]))
    plain = [i for i in order if len(pairs[i][0]) <= WORD]
    for i in order:
        if len(pairs[i][0]) > WORD:
            out[i] = _lcs_long(*pairs[i])
    for at in range(0, len(plain), SIDE):
        some = plain[at : at + SIDE]
        short, long = ([pairs[i][k] for i in some] for k in (0, 1))
        x = _matrix(short, WORD, _PADS[0])
        size = np.array([len(t) for t in short])
        full = np.uint64(0xFFFF_FFFF_FFFF_FFFF) >> (WORD - size).astype(np.uint64)
        row = full.copy()
        for c in _matrix(long, max(map(len, long)), _PADS[1]).T:
            hit = row & np.packbits(x == c[:, None], axis=1, bitorder="little").view("<u8")[:, 0]
            row = ((row + hit) | (row - hit)) & full
        out[some] = size - np.bitwise_count(row).astype(np.int64)
    return out


def _sizes(texts: Strings) -> np.ndarray:
    return np.array([len(t) for t in texts], dtype=np.int64)


def ratios(a: Strings, b: Strings) -> np.ndarray:
    total = _sizes(a) + _sizes(b)
    return np.where(total > 0, 2 * lcs_lengths(a, b) / np.maximum(total, 1), 1.0)


def jaro_winklers(a: Strings, b: Strings) -> np.ndarray:
    out = np.zeros(len(a))
    order = sorted(range(len(a)), key=lambda i: max(len(a[i]), len(b[i])))
    for at in range(0, len(order), SIDE):
        some = order[at : at + SIDE]
        out[some] = _jaro_winkler_block([a[i] for i in some], [b[i] for i in some])
    return out


def _jaro_winkler_block(a: Strings, b: Strings) -> np.ndarray:
    n, m = _sizes(a), _sizes(b)
    x, y = _matrix(a, max(4, n.max()), _PADS[0]), _matrix(b, max(4, m.max()), _PADS[1])
    reach = np.maximum(0, np.maximum(n, m) // 2 - 1)[:, None]
    used, met = np.zeros(y.shape, dtype=bool), np.zeros(x.shape, dtype=bool)
    rows, place = np.arange(len(a)), np.arange(y.shape[1])
    for i in range(int(n.max())):
        free = (y == x[:, i, None]) & ~used & (place >= i - reach) & (place <= i + reach)
        first = free.argmax(axis=1)
        met[:, i] = free[rows, first]
        used[rows[met[:, i]], first[met[:, i]]] = True
    hits = met.sum(axis=1)
    left, right = (np.take_along_axis(t, np.argsort(~k, axis=1, kind="stable"), axis=1) for t, k in ((x, met), (y, used)))
    width = min(left.shape[1], right.shape[1])
    swapped = ((left[:, :width] != right[:, :width]) & (np.arange(width) < hits[:, None])).sum(axis=1) // 2
    some = np.maximum(hits, 1)
    score = (hits / np.maximum(n, 1) + hits / np.maximum(m, 1) + (hits - swapped) / some) / 3
    same = np.logical_and.accumulate(x[:, :4] == y[:, :4], axis=1).sum(axis=1)
    score = np.where(score > 0.7, score + 0.1 * same * (1 - score), score)
    return np.where([p == q for p, q in zip(a, b)], 1.0, np.where(hits > 0, score, 0.0))


def _sorted(text: str) -> str:
    return " ".join(sorted(text.split()))


def token_sorts(a: Strings, b: Strings) -> np.ndarray:
    return ratios(list(map(_sorted, a)), list(map(_sorted, b)))


def _parts(a: Strings, b: Strings) -> tuple[Strings, Strings, Strings]:
    """The tokens of each pair that both have, only the first has, only the second has, in order."""
    sets = [(set(x.split()), set(y.split())) for x, y in zip(a, b)]
    return tuple([" ".join(sorted(f(x, y))) for x, y in sets] for f in (set.intersection, set.difference, lambda x, y: y - x))


def token_sets(a: Strings, b: Strings) -> np.ndarray:
    """1 if one side's tokens hold the other's; else the best of the shared and the two joint strings."""
    both, left, right = _parts(a, b)
    c, n, m = _sizes(both), _sizes(left), _sizes(right)
    gap = (c > 0).astype(np.int64)
    first, second = c + gap + n, c + gap + m
    apart = n + m - 2 * lcs_lengths(left, right)
    best = 1 - apart / np.maximum(first + second, 1)
    for size, whole in ((n, first), (m, second)):
        best = np.where(c > 0, np.maximum(best, 1 - (gap + size) / np.maximum(c + whole, 1)), best)
    best = np.where((c > 0) & ((n == 0) | (m == 0)), 1.0, best)
    return np.where([bool(x.split()) and bool(y.split()) for x, y in zip(a, b)], best, 0.0)


def _windows(short: str, long: str) -> set[str]:
    n = len(short)
    return {long[:k] for k in range(1, n)} | {long[k : k + n] for k in range(len(long) - n + 1)} | {long[-k:] for k in range(1, n)}


def partials(a: Strings, b: Strings) -> np.ndarray:
    """The shorter string against its best stretch of the longer, cut short at either end too."""
    out = np.array([float(x == y) for x, y in zip(a, b)])
    owner: list[int] = []
    short: Strings = []
    pieces: Strings = []

    def settle() -> None:
        np.maximum.at(out, owner, ratios(short, pieces))
        owner.clear(), short.clear(), pieces.clear()

    for i, (x, y) in enumerate(zip(a, b)):
        if not x or not y or x == y:
            continue
        for p, q in [(x, y), (y, x)] if len(x) == len(y) else [(x, y) if len(x) < len(y) else (y, x)]:
            found = _windows(p, q)
            owner += [i] * len(found)
            short += [p] * len(found)
            pieces += found
        if len(pieces) > WINDOWS:
            settle()
    settle()
    return out


def partial_tokens(a: Strings, b: Strings) -> np.ndarray:
    both, left, right = _parts(a, b)
    best = np.ones(len(a))
    some = [i for i, t in enumerate(both) if not t]
    by_order = partials([_sorted(a[i]) for i in some], [_sorted(b[i]) for i in some])
    best[some] = np.maximum(by_order, partials([left[i] for i in some], [right[i] for i in some]))
    return best


def weighteds(a: Strings, b: Strings) -> np.ndarray:
    """Weighted best of plain, token and partial scores, by the ratio of lengths."""
    n, m = _sizes(a), _sizes(b)
    spread = np.maximum(n, m) / np.maximum(np.minimum(n, m), 1)
    best = ratios(a, b)
    near, far = np.flatnonzero(spread < 1.5), np.flatnonzero(spread >= 1.5)
    x, y = [a[i] for i in near], [b[i] for i in near]
    best[near] = np.maximum(best[near], 0.95 * np.maximum(token_sorts(x, y), token_sets(x, y)))
    x, y, scale = [a[i] for i in far], [b[i] for i in far], np.where(spread[far] <= 8, 0.9, 0.6)
    best[far] = np.maximum(best[far], np.maximum(scale * partials(x, y), 0.95 * scale * partial_tokens(x, y)))
    return np.where((n > 0) & (m > 0), best, 0.0)


SCORERS: dict[str, Callable[[Strings, Strings], np.ndarray]] = {"jw": jaro_winklers, "token_sort": token_sorts, "token_set": token_sets, "partial": partials, "weighted": weighteds}


def one(score: Callable[[Strings, Strings], np.ndarray], a: str, b: str):
    """The score of a single pair."""
    return score([a], [b])[0]


def scorer(name: str):
    @F.pandas_udf(T.FloatType())
    def score(a: pd.Series, b: pd.Series) -> pd.Series:
        # pairs repeat the same strings; each two are scored once a batch
        code, pairs = pd.factorize(pd.Series(list(zip(a, b)), dtype=object))
        empty = np.array([float(not x and not y) for x, y in pairs])
        some = [i for i, (x, y) in enumerate(pairs) if x and y]
        empty[some] = SCORERS[name]([pairs[i][0] for i in some], [pairs[i][1] for i in some])
        return pd.Series(empty[code], dtype="float32")

    return score


def overlap(a: Column, b: Column) -> Column:
    """Shared distinct members over the larger set; two empty sets are alike."""
    x, y = F.array_distinct(a), F.array_distinct(b)
    most = F.greatest(F.size(x), F.size(y))
    return F.when(most == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(x, y)) / F.greatest(most, F.lit(1)))


def token_overlap(a: Column, b: Column) -> Column:
    return overlap(tokens(a), tokens(b))


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the common prefix over the shorter length; 0 if either is empty."""
    shorter = F.least(F.length(a), F.length(b))
    same = F.aggregate(
        F.sequence(F.lit(1), F.greatest(shorter, F.lit(1))),
        F.lit(0),
        lambda n, i: F.when((n == i - 1) & (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1))), i).otherwise(n),
    )
    return F.when(shorter == 0, F.lit(0.0)).otherwise(same / F.greatest(shorter, F.lit(1)))


def length_ratio(a: Column, b: Column) -> Column:
    most = F.greatest(F.length(a), F.length(b))
    return F.when(most == 0, F.lit(1.0)).otherwise(F.least(F.length(a), F.length(b)) / F.greatest(most, F.lit(1)))
