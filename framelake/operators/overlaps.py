"""How many boxes each box of a crowded tile overlaps, and the highest IoU, without laying out all pairs.

Counts are sums over corners; the highest IoU is sought among boxes of like size and place, the nearest first.
"""

from __future__ import annotations

import numpy as np

FEW = 1 << 16  # pairs that are laid out at once
RATIO = 2  # sides of one class differ by less
LEVELS = (0.75, 0.5, 0.25, 0.0)


def _below(px, py, weight, qx, qy, x_side: str, y_side: str) -> np.ndarray:
    """Weight of the points with px below qx and py below qy; side is left for less, right for less or equal. A walk down the bits of the points' ranks."""
    by_x = np.argsort(px, kind="stable")
    by_y = np.argsort(py, kind="stable")
    rank = np.empty(len(px), np.int64)
    rank[by_y] = np.arange(len(px))
    now, w = rank[by_x], weight[by_x]
    hi, want = np.searchsorted(px[by_x], qx, x_side), np.searchsorted(py[by_y], qy, y_side)
    lo, total = np.zeros(len(qx), np.int64), np.zeros(len(qx), np.int64)
    for bit in range(len(px).bit_length() - 1, -1, -1):
        zero = (now >> bit) & 1 == 0
        zeros, weights = np.r_[0, np.cumsum(zero)], np.r_[0, np.cumsum(np.where(zero, w, 0))]
        one = (want >> bit) & 1 == 1
        total += np.where(one, weights[hi] - weights[lo], 0)
        n = zeros[-1]
        lo, hi = np.where(one, n + lo - zeros[lo], zeros[lo]), np.where(one, n + hi - zeros[hi], zeros[hi])
        now, w = np.r_[now[zero], now[~zero]], np.r_[w[zero], w[~zero]]
    return total


def counted(d: np.ndarray, g: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weight of the boxes g that share area with each box of d; corners x1, y1, x2, y2 in rows."""
    if not g.shape[1] or not d.shape[1]:
        return np.zeros(d.shape[1], np.int64)
    gx1, gy1, gx2, gy2 = g
    dx1, dy1, dx2, dy2 = d
    out = _below(gx1, gy1, weight, dx2, dy2, "left", "left") - _below(gx2, gy1, weight, dx1, dy2, "right", "left")
    return out - _below(gx1, gy2, weight, dx2, dy1, "left", "right") + _below(gx2, gy2, weight, dx1, dy1, "right", "right")


def _iou(d, g) -> np.ndarray:
    """IoU of boxes that share area, else 0; the arithmetic of ``geometry.iou``."""
    w, h = np.minimum(d[2], g[2]) - np.maximum(d[0], g[0]), np.minimum(d[3], g[3]) - np.maximum(d[1], g[1])
    both = np.where((w > 0) & (h > 0), w * h, 0.0)
    return both / ((d[2] - d[0]) * (d[3] - d[1]) + (g[2] - g[0]) * (g[3] - g[1]) - both)


def _look(d, g, at, lo, hi, best) -> None:
    """Raise ``best`` of the boxes ``at`` by the boxes lo to hi of g, ``FEW`` pairs at a time."""
    some = hi > lo
    at, lo, n = at[some], lo[some], (hi - lo)[some]
    ends = np.cumsum(n)
    done = 0
    while done < len(at):
        last = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + FEW, "right")))
        k, a = n[done:last], at[done:last]
        starts = np.cumsum(k) - k
        near = np.arange(k.sum()) + np.repeat(lo[done:last] - starts, k)
        found = np.maximum.reduceat(_iou(d[:, np.repeat(a, k)], g[:, near]), starts)
        best[a] = np.maximum(best[a], found)
        done = last


class _Class:
    """Boxes of like width and height, in strips by y1, by x1 within a strip."""

    def __init__(self, g):
        w, h = g[2] - g[0], g[3] - g[1]
        self.w, self.h, self.least = w.max(), h.max(), w.min() * h.min()
        self.strip = self.h / 2
        strip = np.floor(g[1] / self.strip)
        self.strips, s = np.unique(strip, return_inverse=True)
        self.xs, x = np.unique(g[0], return_inverse=True)
        code = s * (len(self.xs) + 1) + x
        order = np.argsort(code, kind="stable")
        self.code, self.g = code[order], g[:, order]

    def search(self, d, size, at, level, best) -> None:
        """Raise ``best`` of the boxes ``at`` to the highest IoU with these boxes, if it reaches ``level``."""
        w, h = np.minimum(size[0, at], self.w), np.minimum(size[1, at], self.h)
        area = size[0, at] * size[1, at]
        bound = w * h / (area + np.maximum(self.least - w * h, 0)) * (1 + 1e-9)
        wanted = np.maximum(level, best[at])
        may = bound > wanted
        at, w, h, wanted = at[may], w[may], h[may], wanted[may]
        if not len(at):
            return
        # where IoU reaches t, a side's ends lie no further apart than (1 - t) / t of its shorter one
        share = np.minimum((1 - wanted) / np.maximum(wanted, 1e-12), 1e9) * (1 + 1e-6) + 1e-9
        x1, y1, x2, y2 = d[:, at]
        slack = 1e-12 * np.maximum(np.abs(x1), np.abs(y1))
        left, right = np.maximum(x1 - share * w, x1 - self.w) - slack, np.minimum(x1 + share * w, x2) + slack
        top, under = np.maximum(y1 - share * h, y1 - self.h) - slack, np.minimum(y1 + share * h, y2) + slack
        first, after = np.searchsorted(self.strips, np.floor(top / self.strip)), np.searchsorted(self.strips, np.floor(under / self.strip), "right")
        left, right = np.searchsorted(self.xs, left), np.searchsorted(self.xs, right, "right")
        for k in range(int((after - first).max(initial=0))):
            go = first + k < after
            base = (first[go] + k) * (len(self.xs) + 1)
            _look(d, self.g, at[go], np.searchsorted(self.code, base + left[go]), np.searchsorted(self.code, base + right[go]), best)


def highest(d: np.ndarray, g: np.ndarray) -> np.ndarray:
    """The highest IoU of each box of d with a box of g, 0 where none shares area.

    Levels of IoU are tried downwards: a box that reaches the level of its search can only be beaten by boxes that were within its reach, so it is done.
    """
    best = np.zeros(d.shape[1])
    if not g.shape[1] or not d.shape[1]:
        return best
    g = np.unique(g, axis=1)
    if d.shape[1] * g.shape[1] <= FEW:
        n = g.shape[1]
        at = np.arange(d.shape[1])
        _look(d, g, at, np.zeros(len(at), np.int64), np.full(len(at), n), best)
        return best
    kinds = np.floor(np.log(np.stack([g[2] - g[0], g[3] - g[1]])) / np.log(RATIO)).astype(np.int64)
    kinds, of = np.unique(kinds, axis=1, return_inverse=True)
    order = np.argsort(of.ravel(), kind="stable")
    classes = [_Class(g[:, part]) for part in np.split(order, np.cumsum(np.bincount(of.ravel()))[:-1])]
    size = np.stack([d[2] - d[0], d[3] - d[1]])
    open_ = np.arange(d.shape[1])
    for level in LEVELS:
        for c in classes if len(open_) else ():
            c.search(d, size, open_, level, best)
        open_ = open_[best[open_] < level]
    return best


def in_tile(d: np.ndarray, g: np.ndarray, weight: np.ndarray, left: float, top: float) -> tuple[np.ndarray, np.ndarray]:
    """For boxes that lie in a tile: the weight of the boxes g whose intersection with a box of d begins in it, and the highest IoU with a box of g."""
    inside = np.stack([d[0] >= left, d[1] >= top])
    n = np.zeros(d.shape[1], np.int64)
    for x in (True, False):
        for y in (True, False):
            mine = (inside[0] == x) & (inside[1] == y)
            # what began before the tile meets here only boxes that begin in it
            true = (x | (g[0] >= left)) & (y | (g[1] >= top))
            n[mine] = counted(d[:, mine], g[:, true], weight[true])
    return n, highest(d, g)
