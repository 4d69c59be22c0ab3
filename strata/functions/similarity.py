"""String similarity scores used by entity resolution (pure Python helpers
called inside Arrow-batched pandas UDFs on candidate pairs only).

Normalised Indel similarity: ``ratio(a, b) = 100 * 2 * LCS(a, b) / (|a| + |b|)``
with a bit-parallel LCS length (Allison-Dix / Hyyrö)."""

from __future__ import annotations


def lcs_len(a: str, b: str) -> int:
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        u = v & masks.get(ch, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def ratio(a: str, b: str) -> float:
    la, lb = len(a), len(b)
    if la + lb == 0:
        return 100.0
    return 100.0 * 2 * lcs_len(a, b) / (la + lb)


def token_set_ratio(a: str, b: str) -> float:
    """Token-set similarity: 100 when one token set contains the other (and they
    intersect); otherwise the best of the intersection-vs-rest ratios."""
    ta, tb = set(a.split()), set(b.split())
    if not ta or not tb:
        return 0.0
    inter = ta & tb
    dab, dba = ta - tb, tb - ta
    if inter and (not dab or not dba):
        return 100.0
    s_ab = " ".join(sorted(dab))
    s_ba = " ".join(sorted(dba))
    sect = " ".join(sorted(inter))
    sl = len(sect)
    ab_len = sl + (1 if sl else 0) + len(s_ab)
    ba_len = sl + (1 if sl else 0) + len(s_ba)
    total = ab_len + ba_len
    dist = len(s_ab) + len(s_ba) - 2 * lcs_len(s_ab, s_ba)
    best = 100.0 * (1 - dist / total) if total else 0.0
    if not sl:
        return best
    r1 = 100.0 * (1 - ((1 if sl else 0) + len(s_ab)) / (sl + ab_len))
    r2 = 100.0 * (1 - ((1 if sl else 0) + len(s_ba)) / (sl + ba_len))
    return max(best, r1, r2)


def partial_ratio(a: str, b: str) -> float:
    """Best ``ratio`` of the shorter string against every same-length window of
    the longer one, including the partial windows at both ends; of strings of the
    same length either is taken as the shorter one."""
    if not a or not b:
        return 100.0 if not a and not b else 0.0
    if len(a) == len(b):
        return max(_best_window(a, b), _best_window(b, a))
    return _best_window(a, b) if len(a) < len(b) else _best_window(b, a)


def _best_window(s: str, t: str) -> float:
    n, m = len(s), len(t)
    masks: dict[str, int] = {}
    for i, ch in enumerate(s):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << n) - 1
    row = [masks.get(ch, 0) for ch in t]
    best = 0.0
    for i in range(1 - n, m):
        window = row[max(i, 0):i + n]
        size = n + len(window)
        if 200.0 * min(len(window), n) / size <= best:
            continue  # a window this short cannot do better
        v = full
        for x in window:
            u = v & x
            v = ((v + u) | (v - u)) & full
        score = 100.0 * 2 * (n - v.bit_count()) / size
        if score > best:
            best = score
            if best == 100.0:
                break
    return best


def partial_ratio_upper_bound(s_counts: dict, s_len: int, t_counts: dict, t_len: int) -> float:
    """Upper bound of ``partial_ratio(s, t)`` from character counts. With n the
    shorter length, every window w (|w| <= n) has LCS <= C (characters shared,
    with multiplicity), and 2*min(m, C)/(n + m) is maximal at m = C, giving
    100 * 2C / (n + C)."""
    n = min(s_len, t_len)
    if n == 0:
        return 100.0
    common = sum(min(k, t_counts.get(ch, 0)) for ch, k in s_counts.items())
    return 100.0 * 2 * common / (n + common) if common else 0.0
