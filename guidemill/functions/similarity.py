"""String similarity on a scale of 0 to 100, from the published definitions: indel ratio, token sets, and their weighted blend."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit rows."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    row = (1 << len(a)) - 1
    full = row
    for c in b:
        met = row & places.get(c, 0)
        row = ((row + met) | (row - met)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """200 * common subsequence / total length; two empty strings are equal."""
    return 200 * _common(a, b) / (len(a) + len(b)) if a or b else 100.0


def token_sort_ratio(a: str, b: str) -> float:
    return ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))


def token_set_ratio(a: str, b: str) -> float:
    one, two = set(a.split()), set(b.split())
    if not one or not two:
        return 0.0
    both, left, right = (" ".join(sorted(x)) for x in (one & two, one - two, two - one))
    if both and (not left or not right):
        return 100.0
    with_left, with_right = f"{both} {left}".strip(), f"{both} {right}".strip()
    return max(ratio(with_left, with_right), *((ratio(both, with_left), ratio(both, with_right)) if both else (0.0,)))


def token_ratio(a: str, b: str) -> float:
    return max(token_sort_ratio(a, b), token_set_ratio(a, b))


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter string with a window of the longer one, also one that begins before it or ends after it."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 100.0 if not b else 0.0
    n = len(a)
    return max(ratio(a, b[max(0, k) : min(len(b), k + n)]) for k in range(1 - n, len(b)))


def partial_token_ratio(a: str, b: str) -> float:
    one, two = set(a.split()), set(b.split())
    if one & two:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(" ".join(sorted(one)), " ".join(sorted(two))))


def weighted_ratio(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    longer = max(len(a), len(b)) / min(len(a), len(b))
    if longer < 1.5:
        return max(ratio(a, b), 0.95 * token_ratio(a, b))
    part = 0.9 if longer <= 8 else 0.6
    return max(ratio(a, b), part * partial_ratio(a, b), 0.95 * part * partial_token_ratio(a, b))


def _most(queries: list[str], choices: list[str]) -> np.ndarray:
    """What no weighted ratio of a query and a choice exceeds, from lengths and counts of characters.

    Two strings have no longer common subsequence than they share characters, m. So their ratio is at most 200 m / (sum of lengths), and that of the
    shorter one, of length n, with a window of the other at most 200 m / (n + m). The token ratios are of the same characters unless a word is shared
    or repeated or white space isn't single: there the bound is 100."""
    place: dict[str, int] = {}
    for x in (*queries, *choices):
        for c in x:
            place.setdefault(c, len(place))

    def counted(strings: list[str]) -> np.ndarray:
        out = np.zeros((len(strings), len(place)), np.int32)
        for k, x in enumerate(strings):
            for c in x:
                out[k, place[c]] += 1
        return out

    a, b = counted(queries), counted(choices)
    m = np.zeros((len(queries), len(choices)))
    for c in range(len(place)):
        m += np.minimum(a[:, c, None], b[None, :, c])
    n, o = a.sum(1)[:, None], b.sum(1)[None, :]
    short, long = np.maximum(np.minimum(n, o), 1), np.maximum(n, o)
    part = np.where(long < 1.5 * short, 0.0, np.where(long <= 8 * short, 0.9, 0.6))
    most = np.maximum(200 * m / np.maximum(n + o, 1), part * 200 * m / (short + m))
    odd = lambda x: len(set(x.split())) < len(x.split()) or " ".join(x.split()) != x
    most[[odd(x) for x in queries], :] = 100.0
    most[:, [odd(x) for x in choices]] = 100.0
    having: dict[str, list[int]] = {}
    for k, x in enumerate(choices):
        for w in set(x.split()):
            having.setdefault(w, []).append(k)
    for k, x in enumerate(queries):
        for w in set(x.split()):
            most[k, having.get(w, [])] = 100.0
    return most


def best_choices(queries: list[str], choices: list[str], limit: int, cutoff: float) -> list[list[tuple[str, float]]]:
    """For each query the `limit` distinct choices of the highest weighted ratio, at least cutoff; of equal ones the first in order.

    Choices are scored from the highest bound down, until none that is left can reach the cutoff or a place."""
    out, slack = [], 1e-6
    for q, most in zip(queries, _most(queries, choices), strict=True):
        found, top = [], []
        for k in np.argsort(-most, kind="stable"):
            if most[k] < cutoff - slack or len(top) == limit and most[k] < top[0] - slack:
                break
            score = weighted_ratio(q, choices[k])
            if score >= cutoff:
                found.append((-score, choices[k]))
                (heapq.heappush if len(top) < limit else heapq.heappushpop)(top, score)
        out.append([(c, -s) for s, c in sorted(found)[:limit]])
    return out


def blend(a: str, b: str, weights: tuple[float, float, float, float] = (0.35, 0.30, 0.20, 0.15)) -> float:
    """Weighted blend of the weighted, token-set, token-sort and compact ratios."""
    parts = weighted_ratio(a, b), token_set_ratio(a, b), token_sort_ratio(a, b), ratio(a.replace(" ", ""), b.replace(" ", ""))
    return min(100.0, sum(w * x for w, x in zip(weights, parts, strict=True)))


def _vector(f):
    @pandas_udf(DoubleType())
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")

    return run


ratio_of = _vector(ratio)
token_set_ratio_of = _vector(token_set_ratio)
weighted_ratio_of = _vector(weighted_ratio)
blend_of = _vector(blend)
