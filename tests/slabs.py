"""Common area of polygon geometries by vertical slabs: slow and simple, to check the library against."""

import numpy as np


def part_numbers(rings):
    """Each exterior opens a part; holes belong to the part before them."""
    numbers, k = [], -1
    for ring in rings:
        k += 0 if ring["hole"] else 1
        numbers.append(max(k, 0))
    return numbers


def edges_of(rings):
    out = []
    for ring, k in zip(rings, part_numbers(rings), strict=True):
        pts = [(p["x"], p["y"]) for p in ring["pts"]]
        out += [(*a, *b, k) for a, b in zip(pts, pts[1:], strict=False)]
    return out


def crossing_xs(edges):
    xs = []
    for i, (x1, y1, x2, y2, _) in enumerate(edges):
        for x3, y3, x4, y4, _ in edges[:i]:
            dx, dy, ex, ey = x2 - x1, y2 - y1, x4 - x3, y4 - y3
            det = dx * ey - dy * ex
            if det:
                t, u = ((x3 - x1) * ey - (y3 - y1) * ex) / det, ((x3 - x1) * dy - (y3 - y1) * dx) / det
                if 0 <= t <= 1 and 0 <= u <= 1:
                    xs.append(x1 + t * dx)
    return xs


def covered(edges, x):
    """Covered y-intervals of the union of all parts (each even-odd) on the vertical line at x."""
    by_part = {}
    for x1, y1, x2, y2, k in edges:
        if min(x1, x2) < x < max(x1, x2):
            by_part.setdefault(k, []).append(y1 + (x - x1) / (x2 - x1) * (y2 - y1))
    pieces = []
    for ys in by_part.values():
        ys.sort()
        pieces += zip(ys[0::2], ys[1::2], strict=True)
    merged = []
    for lo, hi in sorted(pieces):
        if merged and lo <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def covered_area(rings, mask_rings=None):
    """Area of the union of the parts, within a second geometry if given: exact, as edges do not cross inside a slab."""
    edges = edges_of(rings)
    mask = edges_of(mask_rings) if mask_rings is not None else None
    both = edges + (mask or [])
    xs = np.unique([x for e in both for x in (e[0], e[2])] + crossing_xs(both))
    total = 0.0
    for a, b in zip(xs, xs[1:], strict=False):
        if b - a < 1e-12:
            continue
        cover = covered(edges, (a + b) / 2)
        if mask is None:
            length = sum(hi - lo for lo, hi in cover)
        else:
            length = sum(max(0.0, min(h, h2) - max(lo, lo2)) for lo, h in cover for lo2, h2 in covered(mask, (a + b) / 2))
        total += length * (b - a)
    return float(total)
