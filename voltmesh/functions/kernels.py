"""Geometry that has no closed form as a column expression: numpy on one shape at a time, inside Arrow tasks.

Lines and rings are arrays of shape (n, 2). A region is a list of rings and the distance by
which it is dilated, so that unions and buffers need no outline of their own.
"""

from __future__ import annotations

import math

import numpy as np

Line = np.ndarray
Region = tuple[list[np.ndarray], float]


def is_closed(line: Line) -> bool:
    return len(line) > 1 and bool((line[0] == line[-1]).all())


def length(line: Line) -> float:
    return float(np.hypot(*np.diff(line, axis=0).T).sum()) if len(line) > 1 else 0.0


def merged_lines(parts: list[Line], ends: list[tuple[tuple, tuple]] | None = None) -> list[Line]:
    """Parts joined wherever exactly two ends meet; junctions of three or more stay ends. Result and directions are fixed by the input's order.

    ends: the first and last point of each part as tuples, where they are at hand; parts then have two points or more.
    """
    if ends is None:
        parts = [p for p in parts if len(p) > 1]
        ends = [(tuple(p[0].tolist()), tuple(p[-1].tolist())) for p in parts]
    at: dict[tuple, list[tuple[int, int]]] = {}
    for i, (first, last) in enumerate(ends):
        at.setdefault(first, []).append((i, 0))
        at.setdefault(last, []).append((i, -1))
    used, out = [False] * len(parts), []

    def follow(i: int, end: int) -> list[Line]:
        """Parts on from the given end of part i, each directed away from it."""
        chain = []
        while True:
            here = at[ends[i][end]]
            if len(here) != 2:
                return chain
            j, other = here[1] if here[0] == (i, end) else here[0]
            if used[j]:
                return chain
            used[j] = True
            chain.append(parts[j] if other == 0 else parts[j][::-1])
            i, end = j, -1 if other == 0 else 0

    for i, p in enumerate(parts):
        if not used[i]:
            used[i] = True
            after = follow(i, -1)
            before = [x[::-1] for x in follow(i, 0)][::-1]
            chain = [*before, p, *after]
            out.append(np.concatenate([chain[0], *(x[1:] for x in chain[1:])]))
    return out


def without_loops(parts: list[Line], rounds: int = 5) -> list[Line]:
    """Merged lines without closed parts; dropping a loop can make two ends meet, so it is done again a few times."""
    for _ in range(rounds):
        open_ = [p for p in parts if not is_closed(p)]
        now = merged_lines(open_)
        if len(now) == len(parts):
            return now
        parts = now
    return parts


def convex_hull(points: np.ndarray) -> np.ndarray:
    """The hull as a closed ring, counter-clockwise; fewer than three distinct points come back sorted."""
    pts = np.unique(points, axis=0)
    if len(pts) < 3:
        return pts
    turn = lambda o, a, b: (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])

    def half(seq) -> list:
        chain: list = []
        for p in seq:
            while len(chain) > 1 and turn(chain[-2], chain[-1], p) <= 0:
                chain.pop()
            chain.append(p)
        return chain[:-1]

    ring = half(pts) + half(pts[::-1])
    return np.array([*ring, ring[0]])


def ring_area(ring: np.ndarray) -> float:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return abs(float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum())) / 2


def in_ring(p: np.ndarray, ring: np.ndarray) -> bool:
    a, b = ring[:-1], ring[1:]
    over = (a[:, 1] > p[1]) != (b[:, 1] > p[1])
    a, b = a[over], b[over]
    return bool(np.count_nonzero(p[0] < (b[:, 0] - a[:, 0]) * (p[1] - a[:, 1]) / (b[:, 1] - a[:, 1]) + a[:, 0]) % 2)


def _in_ring(p: np.ndarray, ring: np.ndarray) -> np.ndarray:
    """in_ring() for each of some points."""
    a, b = ring[:-1], ring[1:]
    x, y = p[:, :1], p[:, 1:]
    over, rise = (a[:, 1] > y) != (b[:, 1] > y), b[:, 1] - a[:, 1]
    return np.count_nonzero(over & (x < (b[:, 0] - a[:, 0]) * (y - a[:, 1]) / np.where(rise == 0, 1.0, rise) + a[:, 0]), axis=1) % 2 == 1


def distance_to_path(p: np.ndarray, line: Line) -> float:
    """Least distance of a point to a line's segments; to the point itself if it has but one."""
    if len(line) == 1:
        return float(np.hypot(*(line[0] - p)))
    a, d = line[:-1], np.diff(line, axis=0)
    t = np.clip(((p - a) * d).sum(1) / np.maximum((d * d).sum(1), 1e-300), 0, 1)
    return float(np.hypot(*(a + t[:, None] * d - p).T).min())


def without_repeats(line: Line) -> Line:
    """A line without points that equal the one before them."""
    return line[np.concatenate([[True], (line[1:] != line[:-1]).any(1)])] if len(line) else line


def _cross(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return u[..., 0] * v[..., 1] - u[..., 1] * v[..., 0]


def is_valid(ring: np.ndarray) -> bool:
    """A closed ring of at least three corners whose edges meet only at the ends that neighbours share; a corner may be written twice in a row."""
    ring = without_repeats(ring)
    if len(ring) < 4 or not is_closed(ring) or ring_area(ring) == 0 or len(np.unique(ring[:-1], axis=0)) < len(ring) - 1:
        return False
    n = len(ring) - 1
    a, b = ring[:-1], ring[1:]

    def touches(p: np.ndarray, side: np.ndarray, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Whether points, given their sides of the line through u and v, lie between u and v, ends excepted."""
        return (side == 0) & (((p - u) * (v - u)).sum(-1) > 0) & (((p - v) * (u - v)).sum(-1) > 0)

    for i in range(n - 1):
        u, v, p, q = a[i], b[i], a[i + 1 :], b[i + 1 :]
        d1, d2 = _cross(v - u, p - u), _cross(v - u, q - u)
        d3, d4 = _cross(q - p, u - p), _cross(q - p, v - p)
        if ((d1 * d2 < 0) & (d3 * d4 < 0)).any() or touches(p, d1, u, v).any() or touches(q, d2, u, v).any() or touches(u, d3, p, q).any() or touches(v, d4, p, q).any():
            return False
    return True


def is_convex(ring: np.ndarray) -> bool:
    d = np.diff(without_repeats(ring), axis=0)
    turns = _cross(d, np.roll(d, -1, axis=0))
    return bool((turns >= 0).all() or (turns <= 0).all()) and len(convex_hull(ring)) > 3


def _counter_clockwise(ring: np.ndarray) -> np.ndarray:
    x, y = ring[:, 0] - ring[0, 0], ring[:, 1] - ring[0, 1]
    return ring if (x[:-1] * y[1:] - x[1:] * y[:-1]).sum() >= 0 else ring[::-1]


def united(rings: list[np.ndarray], tolerance: float = 1e-9) -> list[np.ndarray]:
    """The outlines of the union of valid rings, largest first; holes are filled.

    Each edge is cut wherever it meets another ring. Pieces inside another ring go, and of those that
    run along another ring's edge, one stays if the rings lie on the same side of it and none if
    they lie on either side. The pieces that are left are chained. tolerance is a share of the extent.
    """
    rings = _outer([_counter_clockwise(without_repeats(r)) for r in rings if len(r) > 3])
    if len(rings) < 2:
        return rings
    low, high = (f([f(r, axis=0) for r in rings], axis=0) for f in (np.min, np.max))
    eps = tolerance * float((high - low).max())
    boxes = np.array([[*r.min(0), *r.max(0)] for r in rings])
    pieces: list[tuple[np.ndarray, np.ndarray]] = []
    for i, ring in enumerate(rings):
        near = [j for j in np.flatnonzero((boxes[:, 0] <= boxes[i, 2] + eps) & (boxes[i, 0] <= boxes[:, 2] + eps) & (boxes[:, 1] <= boxes[i, 3] + eps) & (boxes[i, 1] <= boxes[:, 3] + eps)) if j != i]
        if not near:
            pieces += zip(ring[:-1], ring[1:], strict=True)
            continue
        e, f = np.concatenate([rings[j][:-1] for j in near]), np.concatenate([np.diff(rings[j], axis=0) for j in near])
        cut: list[tuple[np.ndarray, np.ndarray]] = []
        for a, b in zip(ring[:-1], ring[1:], strict=True):
            d = b - a
            size = float(d @ d)
            det, w = _cross(d, f), e - a
            ok = np.abs(det) > 1e-12 * math.sqrt(size) * np.hypot(*f.T)
            t, u = _cross(w[ok], f[ok]) / det[ok], _cross(w[ok], d) / det[ok]
            slack = eps / np.hypot(*f[ok].T)
            along = w @ d / size
            on = np.abs(_cross(w, d)) <= eps * math.sqrt(size)
            at = np.concatenate([[0.0, 1.0], t[(t > 0) & (t < 1) & (u >= -slack) & (u <= 1 + slack)], along[on & (along > 0) & (along < 1)]])
            at = np.unique(at)
            at = at[np.concatenate([[True], np.diff(at) * math.sqrt(size) > eps])]
            at[-1] = 1.0
            cut += [(a if s == 0 else a + d * s, b if x == 1 else a + d * x) for s, x in zip(at[:-1], at[1:], strict=True)]
        from_, to = (np.array(x) for x in zip(*cut, strict=True))
        keep = _are_outline((from_ + to) / 2, to - from_, i, rings, near, eps)
        pieces += [x for x, k in zip(cut, keep, strict=True) if k]
    outlines = [r for r in _chained(pieces, 8 * eps) if ((r[:-1, 0] - r[0, 0]) * (r[1:, 1] - r[0, 1]) - (r[1:, 0] - r[0, 0]) * (r[:-1, 1] - r[0, 1])).sum() > 0]
    return sorted(outlines, key=ring_area, reverse=True)


def _outer(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Rings without those that lie within a convex one."""
    out: list[np.ndarray] = []
    for r in sorted(rings, key=ring_area, reverse=True):
        low, high = r.min(0), r.max(0)
        for o in out:
            if (o.min(0) <= low).all() and (high <= o.max(0)).all() and is_convex(o):
                a, f = o[:-1], np.diff(o, axis=0)
                if (f[:, None, 0] * (r[None, :, 1] - a[:, None, 1]) - f[:, None, 1] * (r[None, :, 0] - a[:, None, 0]) >= 0).all():
                    break
        else:
            out.append(r)
    return out


def _are_outline(p: np.ndarray, d: np.ndarray, i: int, rings: list[np.ndarray], near: list[int], eps: float) -> np.ndarray:
    """Which pieces of ring i, with middles p and directions d, bound the union of all rings."""
    keep = np.ones(len(p), bool)
    for j in near:
        r = rings[j]
        a, b, f = r[:-1], r[1:], np.diff(r, axis=0)
        x, y = p[:, :1], p[:, 1:]
        t = np.clip(((x - a[:, 0]) * f[:, 0] + (y - a[:, 1]) * f[:, 1]) / (f * f).sum(1), 0, 1)
        far = np.hypot(a[:, 0] + t * f[:, 0] - x, a[:, 1] + t * f[:, 1] - y)
        k = far.argmin(1)
        along = far[np.arange(len(p)), k] <= 4 * eps
        over = (a[:, 1] > y) != (b[:, 1] > y)
        right = x < f[:, 0] * (y - a[:, 1]) / np.where(f[:, 1] == 0, 1.0, f[:, 1]) + a[:, 0]
        inside = np.count_nonzero(over & right, axis=1) % 2 == 1
        keep &= np.where(along, ((f[k] * d).sum(1) >= 0) & (j > i), ~inside)
    return keep


def _chained(pieces: list[tuple[np.ndarray, np.ndarray]], eps: float) -> list[np.ndarray]:
    """Closed rings from directed pieces whose ends meet to within eps; where several leave a place, the sharpest turn to the right is taken, so that rings touch and don't cross."""
    places: dict[tuple[int, int], list[int]] = {}
    points: list[np.ndarray] = []

    def place(p: np.ndarray) -> int:
        cell = np.floor(p / (2 * eps)).astype(np.int64)
        for x in (-1, 0, 1):
            for y in (-1, 0, 1):
                for k in places.get((int(cell[0]) + x, int(cell[1]) + y), ()):
                    if np.hypot(*(points[k] - p)) <= eps:
                        return k
        points.append(p)
        places.setdefault((int(cell[0]), int(cell[1])), []).append(len(points) - 1)
        return len(points) - 1

    leaving: dict[int, list[int]] = {}
    for a, b in ((place(a), place(b)) for a, b in pieces):
        if a != b:
            leaving.setdefault(a, []).append(b)
    out = []
    while leaving:
        at = start = next(iter(leaving))
        chain = [start]
        while at in leaving:
            ways = leaving[at]
            came = points[at] - points[chain[-2]] if len(chain) > 1 else None
            turn = lambda k: math.atan2(float(_cross(came, points[k] - points[at])), float(came @ (points[k] - points[at])))  # noqa: B023, E731
            chosen = ways[0] if came is None or len(ways) == 1 else min(ways, key=turn)
            ways.remove(chosen)
            if not ways:
                del leaving[at]
            at = chosen
            chain.append(at)
            if at == start:
                break
        if at == start and len(chain) > 3:
            out.append(np.array([points[k] for k in chain]))
    return out


def dilated(shape: np.ndarray, radius: float, corners: int = 64) -> list[np.ndarray]:
    """The outlines of a point, line or ring with its inside, moved out by a distance; corners to a full circle."""
    if len(shape) == 1 or (len(shape) > 3 and is_closed(shape) and is_convex(shape)):
        return [dilated_hull(shape, radius, corners)]
    sides = [dilated_hull(shape[k : k + 2], radius, corners) for k in range(len(shape) - 1)]
    return united([shape, *sides] if len(shape) > 3 and is_closed(shape) else sides)


#: A place is taken as the pole if it is farther from the edge by this share of the tolerance: of places that are equal but for rounding or projection the middle stays.
LEAST_GAIN = 1e-3


def pole(ring: np.ndarray, tolerance: float) -> np.ndarray:
    """A point inside a ring that is farthest from its edge, to within tolerance: square cells that could hold a better one are quartered, all of one size at once."""
    low, high = ring.min(0), ring.max(0)
    size = float((high - low).min())
    centre = (low + high) / 2
    if size == 0:
        return ring[0]

    def signed(p: np.ndarray) -> np.ndarray:
        """Distances of places to the ring, negative outside."""
        step = max(1, PAIRS // len(ring))
        return np.concatenate([_far(q, ring) * np.where(_in_ring(q, ring), 1, -1) for q in (p[i : i + step] for i in range(0, len(p), step))])

    start = np.stack([ring[:-1].mean(0), centre])
    far = signed(start)
    k = int(far.argmax())
    best, at = far[k], start[k]
    h = size / 2
    cells = np.stack(np.meshgrid(np.arange(low[0], high[0], size) + h, np.arange(low[1], high[1], size) + h, indexing="ij"), -1).reshape(-1, 2)
    quarters = np.array([[-0.5, -0.5], [-0.5, 0.5], [0.5, -0.5], [0.5, 0.5]])
    while len(cells):
        far = signed(cells)
        k = int(far.argmax())
        if far[k] > best + LEAST_GAIN * tolerance:
            best, at = far[k], cells[k]
        cells = (cells[far + h * math.sqrt(2) - best > tolerance][:, None] + quarters * h).reshape(-1, 2)
        h /= 2
    return ring[0] if best < 0 else at


def poles(rings: list[np.ndarray], tolerance: float) -> np.ndarray:
    """pole() of each of some rings; rings with equally many corners are searched together."""
    out, sizes = np.empty((len(rings), 2)), np.array([len(r) for r in rings], np.int64)
    for n in np.unique(sizes):
        of = np.flatnonzero(sizes == n)
        out[of] = _poles(np.stack([rings[i] for i in of]), tolerance)
    return out


def _poles(rings: np.ndarray, tolerance: float) -> np.ndarray:
    """The poles of rings in an array of shape (rings, corners, 2): each level of cells is one array for all of them."""
    a, b, d = rings[:, :-1], rings[:, 1:], np.diff(rings, axis=1)
    squares, rise = np.maximum((d * d).sum(2), 1e-300), d[..., 1]
    low, high = rings.min(1), rings.max(1)
    size = (high - low).min(1)

    def signed(k: np.ndarray, p: np.ndarray) -> np.ndarray:
        """Distances of places p to the rings k, negative outside."""
        step, found = max(1, PAIRS // rings.shape[1]), [np.empty(0)]
        for i in range(0, len(p), step):
            of, q = k[i : i + step], p[i : i + step]
            w, f = q[:, None] - a[of], d[of]
            t = np.clip((w * f).sum(2) / squares[of], 0, 1)
            rest = t[:, :, None] * f - w
            x, y, up = q[:, :1], q[:, 1:], rise[of]
            over = (a[of, :, 1] > y) != (b[of, :, 1] > y)
            odd = np.count_nonzero(over & (x < f[..., 0] * (y - a[of, :, 1]) / np.where(up == 0, 1.0, up) + a[of, :, 0]), axis=1) % 2 == 1
            found.append(np.hypot(rest[..., 0], rest[..., 1]).min(1) * np.where(odd, 1, -1))
        return np.concatenate(found)

    start = np.stack([a.mean(1), (low + high) / 2], 1)
    far = signed(np.repeat(np.arange(len(rings)), 2), start.reshape(-1, 2)).reshape(-1, 2)
    first = far.argmax(1)
    best, at = far[np.arange(len(rings)), first], start[np.arange(len(rings)), first]
    flat = size == 0
    wide = np.where(flat, 1.0, size)
    n = np.where(flat[:, None], 0, np.ceil((high - low) / wide[:, None])).astype(np.int64)
    counts, h = n[:, 0] * n[:, 1], size / 2
    k = np.repeat(np.arange(len(rings)), counts)
    nth = np.arange(len(k)) - np.repeat(np.cumsum(counts) - counts, counts)
    p = low[k] + np.stack([nth // n[k, 1], nth % n[k, 1]], 1) * size[k, None] + h[k, None] if len(k) else np.empty((0, 2))
    quarters = np.array([[-0.5, -0.5], [-0.5, 0.5], [0.5, -0.5], [0.5, 0.5]])
    while len(k):
        far = signed(k, p)
        begin = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
        top, of = np.maximum.reduceat(far, begin), k[begin]
        tops = np.flatnonzero(far == np.repeat(top, np.diff(np.append(begin, len(k)))))
        tops = tops[np.concatenate([[True], k[tops][1:] != k[tops][:-1]])]
        better = top > best[of] + LEAST_GAIN * tolerance
        best[of[better]], at[of[better]] = top[better], p[tops[better]]
        go = far + h[k] * math.sqrt(2) - best[k] > tolerance
        p = (p[go][:, None] + quarters * h[k[go]][:, None, None]).reshape(-1, 2)
        k, h = np.repeat(k[go], 4), h / 2
    return np.where((flat | (best < 0))[:, None], rings[:, 0], at)


def outside_each(lines: list[Line], regions: list[list[np.ndarray]], wide: float) -> list[list[Line]]:
    """outside() of each line and the rings beside it, dilated by wide: all segments that come near their region are compared at once."""
    sizes = np.array([len(x) for x in lines], np.int64)
    ends = np.cumsum(sizes)
    points = np.concatenate([np.empty((0, 2)), *lines])
    of = np.repeat(np.arange(len(lines)), sizes)
    seg = np.flatnonzero(of[1:] == of[:-1])
    # A ring of one point is an edge without length.
    ring_sizes = [[len(r) for r in x] for x in regions]
    closed = [r if len(r) > 1 else np.repeat(r, 2, axis=0) for x in regions for r in x]
    edges = np.array([len(r) - 1 for r in closed], np.int64)
    e = np.concatenate([np.empty((0, 2)), *(r[:-1] for r in closed)])
    f = np.concatenate([np.empty((0, 2)), *(r[1:] for r in closed)]) - e
    ring_of = np.repeat(np.arange(len(closed)), edges)
    area = np.array([n > 2 for x in ring_sizes for n in x], bool)
    region_of = np.repeat(np.arange(len(regions)), [len(x) for x in ring_sizes])[ring_of] if len(closed) else np.empty(0, np.int64)
    n_edges = np.bincount(region_of, minlength=len(regions))
    first_edge = np.cumsum(n_edges) - n_edges
    box = np.stack([np.full(len(regions), np.inf)] * 2 + [np.full(len(regions), -np.inf)] * 2, 1)
    np.minimum.at(box[:, :2], region_of, np.minimum(e, e + f))
    np.maximum.at(box[:, 2:], region_of, np.maximum(e, e + f))
    slack = wide + 1e-6
    a, b, r = points[seg], points[seg + 1], of[seg]
    near = (np.minimum(a, b) <= box[r, 2:] + slack).all(1) & (np.maximum(a, b) >= box[r, :2] - slack).all(1)
    seg, a, r = seg[near], a[near], r[near]
    d = b[near] - a
    squares = (d * d).sum(1)

    def paired(which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each of some regions, its place in the list with each of its edges."""
        n = n_edges[which]
        i = np.repeat(np.arange(len(which)), n)
        return i, np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + first_edge[which][i]

    i, k = paired(r)
    u, at, g = d[i], a[i], f[k]
    cut_of, cuts = [np.arange(len(seg)), np.arange(len(seg))], [np.zeros(len(seg)), np.ones(len(seg))]
    out = np.stack([-g[:, 1], g[:, 0]], 1) / np.maximum(np.hypot(g[:, 0], g[:, 1]), 1e-300)[:, None] * wide
    det = _cross(u, g)
    ok = det != 0
    safe = np.where(ok, det, 1.0)
    for s in (e[k], e[k] + out, e[k] - out) if wide else (e[k],):
        t, v = _cross(s - at, g) / safe, _cross(s - at, u) / safe
        hit = ok & (t > 0) & (t < 1) & (v >= 0) & (v <= 1)
        cut_of.append(i[hit])
        cuts.append(t[hit])
    if wide:
        for corner in (e[k], e[k] + g):
            w, sq = at - corner, np.where(squares[i] == 0, 1.0, squares[i])
            half = (w * u).sum(1) / sq
            disc = half * half - ((w * w).sum(1) - wide * wide) / sq
            ok = (disc >= 0) & (squares[i] > 0)
            root = np.sqrt(np.where(ok, disc, 0.0))
            for t in (-half - root, -half + root):
                hit = ok & (t > 0) & (t < 1)
                cut_of.append(i[hit])
                cuts.append(t[hit])
    i, t = np.concatenate(cut_of), np.concatenate(cuts)
    order = np.lexsort((t, i))
    i, t = i[order], t[order]
    new = np.flatnonzero((i[1:] == i[:-1]) & (t[1:] > t[:-1]))
    s_of, low, high = i[new], t[new], t[new + 1]
    mid = a[s_of] + d[s_of] * ((low + high) / 2)[:, None]
    i, k = paired(r[s_of])
    q, x, g = mid[i], e[k], f[k]
    w = q - x
    t = np.clip((w * g).sum(1) / np.maximum((g * g).sum(1), 1e-300), 0, 1)
    rest = t[:, None] * g - w
    close = (np.hypot(rest[:, 0], rest[:, 1]) <= wide) & (wide > 0)
    over = (x[:, 1] > q[:, 1]) != (x[:, 1] + g[:, 1] > q[:, 1])
    over &= area[ring_of[k]] & (q[:, 0] < g[:, 0] * (q[:, 1] - x[:, 1]) / np.where(g[:, 1] == 0, 1.0, g[:, 1]) + x[:, 0])
    within_ = np.bincount(i, close, minlength=len(s_of)) > 0
    if len(i):
        begin = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (ring_of[k][1:] != ring_of[k][:-1])]))
        odd = np.add.reduceat(over.astype(np.int64), begin) % 2 == 1
        within_[i[begin[odd]]] = True
    at = seg[s_of[within_]]
    line = of[at] if len(at) else np.empty(0, np.int64)
    stretches = list(zip((at - (ends - sizes)[line]).tolist(), low[within_].tolist(), high[within_].tolist(), strict=True))
    bounds = np.searchsorted(line, np.arange(len(lines) + 1)).tolist()
    same = np.flatnonzero((points[1:] == points[:-1]).all(1) & (of[1:] == of[:-1]))
    repeats = np.bincount(of[same], minlength=len(lines)).tolist()
    parts = ([x] if m == n else _without(x, stretches[m:n]) for x, m, n in zip(lines, bounds[:-1], bounds[1:], strict=True))
    return [[q for q in (map(without_repeats, x) if again else x) if len(q) > 1] for x, again in zip(parts, repeats, strict=True)]


def _without(line: Line, stretches: list[tuple[int, float, float]]) -> list[Line]:
    """The parts of a line without stretches (segment, from, to) of it, in order; single points too."""
    parts, now, at, last = [], [line[:1]], 0, None
    for i, s, e in stretches:
        a, b = line[i], line[i + 1]
        if last == (i, s):
            pass
        elif s > 0:
            parts.append(np.concatenate([*now, line[at + 1 : i + 1], (a + (b - a) * s)[None]]))
        else:
            parts.append(np.concatenate([*now, line[at + 1 : i + 1]]))
        now, at = ([b[None]], i + 1) if e == 1 else ([(a + (b - a) * e)[None]], i)
        last = (i, e)
    return [*parts, np.concatenate([*now, line[at + 1 :]])]


def joined_groups(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """For each of n ids, the smallest that links a, b between ids reach."""
    p = np.arange(n)
    while len(a):
        x, y = p[a], p[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(p, np.maximum(x, y), np.minimum(x, y))
        while ((q := p[p]) != p).any():
            p = q
    return p


def _inside(a: np.ndarray, b: np.ndarray, region: Region) -> list[tuple[float, float]]:
    """Stretches of the segment a to b, as shares of it, that lie inside a region."""
    rings, wide = region
    d = b - a
    cuts = {0.0, 1.0}
    size = float(d @ d)
    for ring in rings:
        if len(ring) > 1:
            e, f = ring[:-1], np.diff(ring, axis=0)
            sides = [(e, f)]
            if wide:
                out = np.stack([-f[:, 1], f[:, 0]], 1) / np.maximum(np.hypot(f[:, 0], f[:, 1]), 1e-300)[:, None] * wide
                sides += [(e + out, f), (e - out, f)]
            for s, g in sides:
                det = d[0] * g[:, 1] - d[1] * g[:, 0]
                ok = det != 0
                w = s[ok] - a
                t = (w[:, 0] * g[ok, 1] - w[:, 1] * g[ok, 0]) / det[ok]
                u = (w[:, 0] * d[1] - w[:, 1] * d[0]) / det[ok]
                cuts.update(t[(t > 0) & (t < 1) & (u >= 0) & (u <= 1)].tolist())
        if wide and size:
            w = a - ring
            half, rest = w @ d / size, ((w * w).sum(1) - wide * wide) / size
            disc = half * half - rest
            root = np.sqrt(disc[disc >= 0])
            t = np.concatenate([-half[disc >= 0] - root, -half[disc >= 0] + root])
            cuts.update(t[(t > 0) & (t < 1)].tolist())
    at = sorted(cuts)
    return [(s, e) for s, e in zip(at[:-1], at[1:], strict=True) if contains(region, a + d * (s + e) / 2)]


def contains(region: Region, p: np.ndarray) -> bool:
    """Whether a point lies in one of the rings or within the region's distance of them."""
    rings, wide = region
    return any((len(r) > 2 and in_ring(p, r)) or (wide > 0 and distance_to_path(p, r) <= wide) for r in rings)


def outside(line: Line, region: Region) -> list[Line]:
    """The parts of a line outside a region, in order; one part where the line is outside throughout."""
    parts: list[list] = [[line[0]]]
    for a, b in zip(line[:-1], line[1:], strict=True):
        for s, e in _inside(a, b, region):
            if s > 0:
                parts[-1].append(a + (b - a) * s)
            parts.append([a + (b - a) * e])
        if (parts[-1][-1] != b).any():
            parts[-1].append(b)
    return [np.array(p) for p in parts if len(p) > 1]


def within(line: Line, region: Region) -> bool:
    """Whether no part of a line is outside a region."""
    return sum(length(p) for p in outside(line, region)) <= 1e-9 * max(1.0, length(line))


def intersects(line: Line, region: Region) -> bool:
    return any(contains(region, p) for p in line) or any(_inside(a, b, region) for a, b in zip(line[:-1], line[1:], strict=True))


def split_at(line: Line, points: list[np.ndarray], tolerance: float = 1e-9) -> list[Line]:
    """A line cut at those of the points that lie on it, ends excepted."""
    cuts = []
    a, d = line[:-1], np.diff(line, axis=0)
    for p in points:
        t = np.clip(((p - a) * d).sum(1) / np.maximum((d * d).sum(1), 1e-300), 0, 1)
        far = np.hypot(*(a + t[:, None] * d - p).T)
        i = int(far.argmin())
        if far[i] <= tolerance and not ((p == line[0]).all() or (p == line[-1]).all()):
            cuts.append((i + float(t[i]), tuple(p)))
    out, now, at = [], [line[0]], 0
    for place, p in sorted(set(cuts)):
        while at < int(place):
            at += 1
            now.append(line[at])
        if (now[-1] != np.array(p)).any():
            now.append(np.array(p))
        if len(now) > 1:
            out.append(np.array(now))
        now = [np.array(p)]
    now += [q for q in line[at + 1 :] if (q != now[-1]).any() or True]
    if len(now) > 1:
        out.append(np.array(now))
    return out


def simplified(line: Line, tolerance: float) -> Line:
    """Douglas-Peucker: the fewest corners that keep within tolerance, by halving at the farthest corner."""
    keep = np.zeros(len(line), bool)
    keep[[0, -1]] = True
    stack = [(0, len(line) - 1)]
    while stack:
        i, j = stack.pop()
        if j - i < 2:
            continue
        pts = line[i + 1 : j]
        d = line[j] - line[i]
        size = np.hypot(*d)
        far = np.abs(d[0] * (pts[:, 1] - line[i, 1]) - d[1] * (pts[:, 0] - line[i, 0])) / size if size else np.hypot(*(pts - line[i]).T)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[i + 1 + k] = True
            stack += [(i, i + 1 + k), (i + 1 + k, j)]
    return line[keep]


def disc(centre: np.ndarray, radius: float, corners: int = 64) -> np.ndarray:
    """A circle as a closed ring."""
    angle = np.linspace(0, 2 * np.pi, corners + 1)
    ring = centre + radius * np.stack([np.cos(angle), np.sin(angle)], 1)
    ring[-1] = ring[0]
    return ring


def dilated_hull(points: np.ndarray, radius: float, corners: int = 64) -> np.ndarray:
    """The outline of the convex hull of some points, moved out by a distance."""
    if len(points) == 1 and radius > 1e-3:
        ring = disc(points[0], radius, corners)[:-1]
        ring = np.roll(ring, -int(np.lexsort(ring.T[::-1])[0]), axis=0)
        return np.concatenate([ring, ring[:1]])
    return convex_hull(np.concatenate([disc(p, radius, corners)[:-1] for p in points]))


def to_metric(line: Line) -> Line:
    """Degrees to metres, as geometry.metric() does for columns."""
    from voltmesh.functions import geometry as G

    lon, lat = np.radians(line[:, 0] - G.LON0), np.radians(line[:, 1])
    sin = np.sin(lat)
    q = (1 - G.E2) * (sin / (1 - G.E2 * sin * sin) - np.log((1 - G._E * sin) / (1 + G._E * sin)) / (2 * G._E))
    beta = np.arcsin(np.clip(q / G._QP, -1, 1))
    b = G._RQ * np.sqrt(2 / (1 + math.sin(G._B0) * np.sin(beta) + math.cos(G._B0) * np.cos(beta) * np.cos(lon)))
    north = b / G._D * (math.cos(G._B0) * np.sin(beta) - math.sin(G._B0) * np.cos(beta) * np.cos(lon))
    return np.stack([G.EAST0 + b * G._D * np.cos(beta) * np.sin(lon), G.NORTH0 + north], 1)


def to_degrees(line: Line) -> Line:
    """Metres to degrees, as geometry.geographic() does for columns."""
    from voltmesh.functions import geometry as G

    x, y = (line[:, 0] - G.EAST0) / G._D, (line[:, 1] - G.NORTH0) * G._D
    rho = np.maximum(np.hypot(x, y), 1e-12)
    c = 2 * np.arcsin(rho / (2 * G._RQ))
    beta = np.arcsin(np.cos(c) * math.sin(G._B0) + y * np.sin(c) * math.cos(G._B0) / rho)
    lon = G.LON0 + np.degrees(np.arctan2(x * np.sin(c), rho * math.cos(G._B0) * np.cos(c) - y * math.sin(G._B0) * np.sin(c)))
    e4, e6 = G.E2**2, G.E2**3
    lat = beta + (G.E2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) * np.sin(2 * beta) + (23 * e4 / 360 + 251 * e6 / 3780) * np.sin(4 * beta) + 761 * e6 / 45360 * np.sin(6 * beta)
    return np.stack([lon, np.degrees(lat)], 1)


def _far(p: np.ndarray, line: Line) -> np.ndarray:
    """Least distance of each of some points to a line's segments, or to the point if it has but one."""
    if len(line) == 1:
        return np.hypot(*(p - line[0]).T)
    a, d = line[:-1], np.diff(line, axis=0)
    w = p[:, None] - a
    t = np.clip((w * d).sum(2) / np.maximum((d * d).sum(1), 1e-300), 0, 1)
    rest = t[:, :, None] * d - w
    return np.hypot(rest[..., 0], rest[..., 1]).min(1)


#: Pairs of corners and edges that are compared at once.
PAIRS = 1_000_000


def gap(a: Line, b: Line) -> float:
    """Least distance between two shapes, each a point or a closed ring with its inside; 0 where they meet."""
    if (len(a) > 3 and in_ring(b[0], a)) or (len(b) > 3 and in_ring(a[0], b)):
        return 0.0
    least = math.inf
    for p, q in ((a, b), (b, a)):
        step = max(1, PAIRS // len(q))
        for i in range(0, len(p), step):
            least = min(least, float(_far(p[i : i + step], q).min()))
            if len(p) > 1 and len(q) > 1 and p is a:
                u, v = p[i : i + step + 1][:-1, None], p[i + 1 : i + step + 1][:, None]
                e, f = q[:-1], q[1:]
                if ((_cross(v - u, e - u) * _cross(v - u, f - u) < 0) & (_cross(f - e, u - e) * _cross(f - e, v - e) < 0)).any():
                    return 0.0
    # Edges of rings that are apart do not cross, so only corners near an edge leave it open.
    if least < 1e-9 * float(np.abs(a).max()) and len(a) > 1 and len(b) > 1 and any(_inside(p, q, ([b], 0.0)) for p, q in zip(a[:-1], a[1:], strict=True)):
        return 0.0
    return least
