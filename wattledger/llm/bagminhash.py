"""BagMinHash: signatures of weighted sets whose collisions estimate weighted Jaccard.

Weights are counts, so the weight axis is cut at the whole numbers. Every element owns a
Poisson process over time and that axis, of rate one per unit of weight; each point falls
into one slot of the signature, and a slot keeps its earliest point of those below the
element's weight. Two multisets agree in a slot with a probability of sum of minima over
sum of maxima.

The process is built in a hierarchy: the axis is [0, 1), [1, 2), [2, 4), [4, 8) and so on,
only intervals below the weight are opened, points of an interval come in order of time, and
a point's place within its interval (the path of fair splits down to one unit) decides
whether it lies below the weight. Generation stops once later points cannot enter, so a
signature costs about a point per element and m log m more, not m per element.
"""

from __future__ import annotations

import numpy as np

from wattledger.llm.rolling import mix

_GAP = np.uint64(0x9E3779B97F4A7C15)
_SLOT = np.uint64(0xC2B2AE3D27D4EB4F)
_PLACE = np.uint64(0x165667B19E3779F9)
#: Points of an element that are drawn together at most.
BLOCK = 64


def _uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1)."""
    return ((x >> np.uint64(12)).astype("f8") + 0.5) * 2.0**-52


def counted(doc: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, element, count) of the distinct pairs; docs ascend."""
    order = np.lexsort((element, doc))
    doc, element = doc[order], element[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (element[1:] != element[:-1])
    at = np.flatnonzero(new)
    return doc[at], element[at], np.diff(np.append(at, len(doc)))


def _intervals(doc, element, count):
    """(doc, seed, low, width, count) of the intervals that elements open."""
    out, j = [], 0
    while len(doc):
        low, width = (0, 1) if j == 0 else (1 << (j - 1), 1 << (j - 1))
        n = len(doc)
        seed = mix(element + np.uint64(j * int(_GAP) & (1 << 64) - 1))
        out.append((doc, seed, np.full(n, low), np.full(n, float(width)), count))
        j += 1
        more = count > (1 << (j - 1))
        doc, element, count = doc[more], element[more], count[more]
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def signatures(doc: np.ndarray, element: np.ndarray, count: np.ndarray, n_docs: int, slots: int) -> np.ndarray:
    """Signatures, n_docs x slots, of multisets given as (doc, element, count).

    Documents without elements have signatures of zeros.
    """
    time = np.full(n_docs * slots, np.inf)
    value = np.zeros(n_docs * slots, dtype="u8")
    if not len(doc):
        return value.reshape(n_docs, slots)
    weight = np.bincount(doc, weights=count, minlength=n_docs)
    limit = np.where(weight > 0, slots * (np.log(slots) + 3) / np.maximum(weight, 1), 0.0)
    doc, seed, low, width, count = _intervals(doc, element, count)
    reached = np.zeros(len(doc))
    drawn = np.zeros(len(doc), dtype="u8")
    pending = np.arange(len(doc))
    while len(pending):
        active, block = pending, 1
        while len(active):
            # Of each active interval, the next points in order of time. Sums run on from
            # the point before, so times don't depend on how draws are blocked.
            step = np.arange(block, dtype="u8")
            draw = mix(seed[active][:, None] ^ mix((drawn[active][:, None] + step + np.uint64(1)) * _GAP))
            gaps = -np.log(_uniform(draw)) / width[active][:, None]
            gaps[:, 0] += reached[active]
            times = np.cumsum(gaps, axis=1)
            inside = times <= limit[doc[active]][:, None]
            rows, cols = np.nonzero(inside)
            which, found, when = active[rows], draw[rows, cols], times[rows, cols]
            place = low[which] + np.floor(_uniform(mix(found ^ _PLACE)) * width[which])
            slot = doc[which] * slots + (mix(found ^ _SLOT) % np.uint64(slots)).astype("i8")
            better = (place < count[which]) & (when < time[slot])
            slot, when, found = slot[better], when[better], found[better]
            latest_first = np.argsort(-when, kind="stable")
            time[slot[latest_first]] = when[latest_first]
            value[slot[latest_first]] = found[latest_first]
            many = inside.sum(axis=1)
            drawn[active] += many.astype("u8")
            some = many > 0
            reached[active[some]] = times[some, many[some] - 1]
            active = active[many == block]
            block = min(BLOCK, 2 * block)
        # A document whose slots are not all taken goes on for longer.
        empty = np.isinf(time.reshape(n_docs, slots)).any(axis=1) & (weight > 0)
        limit = np.where(empty, limit * 2, limit)
        pending = np.flatnonzero(empty[doc])
    return value.reshape(n_docs, slots)


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Exact weighted Jaccard of two (sorted elements, counts); 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - shared
    return shared / total if total else 0.0
