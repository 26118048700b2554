import math

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from voltmesh.functions import kernels as K


def line(*p):
    return np.array(p, float)


SQUARE = line((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))


def test_lines_merge_at_places_where_two_meet():
    a, b, c = line((0, 0), (1, 0)), line((2, 0), (1, 0)), line((2, 0), (3, 1))
    (m,) = K.merged_lines([a, c, b])
    assert sorted([tuple(m[0]), tuple(m[-1])]) == [(0, 0), (3, 1)] and len(m) == 4
    assert len(K.merged_lines([a, b, c, line((1, 0), (1, 5))])) == 3
    assert K.is_closed(K.merged_lines([line((0, 0), (1, 1)), line((1, 1), (2, 0)), line((2, 0), (0, 0))])[0])
    assert K.merged_lines([]) == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=2, max_size=12))
def test_merging_keeps_length(points):
    parts = [line(p, q) for p, q in zip(points, points[1:]) if p != q]
    assert math.isclose(sum(map(K.length, parts)), sum(map(K.length, K.merged_lines(parts))), abs_tol=1e-9)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(-9, 9), st.integers(-9, 9)), min_size=3, max_size=20))
def test_hull_holds_all_points(points):
    hull = K.convex_hull(line(*points))
    if len(hull) > 3:
        assert all(K.in_ring(np.array(p, float), hull) or K.distance_to_path(np.array(p, float), hull) < 1e-9 for p in points)


def test_parts_outside_a_region():
    through = line((-1, 0.5), (2, 0.5))
    parts = K.outside(through, ([SQUARE], 0.0))
    assert [p.tolist() for p in parts] == [[[-1, 0.5], [0, 0.5]], [[1, 0.5], [2, 0.5]]]
    assert K.outside(line((5, 5), (6, 6)), ([SQUARE], 0.0))[0].tolist() == [[5, 5], [6, 6]]
    assert K.within(line((0.1, 0.1), (0.9, 0.9)), ([SQUARE], 0.0)) and not K.within(through, ([SQUARE], 0.0))
    wide = K.outside(line((-10, 0), (10, 0)), ([line((0, 0))], 2.0))
    assert [round(K.length(p), 6) for p in wide] == [8, 8]


def test_pole_of_a_ring_is_inside_and_far_from_the_edge():
    ell = line((0, 0), (4, 0), (4, 1), (1, 1), (1, 4), (0, 4), (0, 0))
    p = K.pole(ell, 0.01)
    assert K.in_ring(p, ell) and K.distance_to_path(p, ell) > 0.5
    assert np.allclose(K.pole(SQUARE, 1e-6), (0.5, 0.5), atol=1e-3)


def test_split_simplify_and_validity():
    parts = K.split_at(line((0, 0), (2, 0), (2, 2)), [np.array((1.0, 0)), np.array((2.0, 1)), np.array((0.0, 0)), np.array((9.0, 9))])
    assert [p.tolist() for p in parts] == [[[0, 0], [1, 0]], [[1, 0], [2, 0], [2, 1]], [[2, 1], [2, 2]]]
    assert len(K.simplified(line((0, 0), (1, 0.01), (2, 0), (3, 5)), 0.1)) == 3
    assert K.is_valid(SQUARE) and not K.is_valid(line((0, 0), (1, 1), (1, 0), (0, 1), (0, 0))) and not K.is_valid(SQUARE[:-1])
    assert K.gap(SQUARE, line((3, 0.5))) == 2 and K.gap(SQUARE, line((0.5, 0.5))) == 0


def test_projection_agrees_with_columns():
    p = np.array([[5.0, 50.0], [-8.0, 37.0]])
    assert np.allclose(K.to_metric(p)[0], (3962799.4509550678, 2999718.8531595636), atol=1e-4)
    assert np.allclose(K.to_degrees(K.to_metric(p)), p, atol=1e-9)


def test_valid_rings():
    twice = line((0, 0), (1, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    spike = line((0, 0), (4, 0), (4, 4), (2, 4), (2, 6), (2, 4), (0, 4), (0, 0))
    touching = line((0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0))
    notch = line((0, 0), (4, 0), (4, 4), (2, 1), (0, 4), (0, 0))
    straight = line((0, 0), (2, 0), (4, 0), (4, 4), (0, 4), (0, 0))
    assert [K.is_valid(x) for x in (twice, spike, touching, notch, straight)] == [True, False, False, True, True]


def square(x, y, size=1.0):
    return SQUARE * size + (x, y)


def test_outlines_of_unions():
    area = lambda rings: [round(K.ring_area(r), 6) for r in rings]
    assert area(K.united([square(0, 0), square(0.5, 0.5)])) == [1.75]
    assert area(K.united([square(0, 0), square(1, 0)])) == [2.0]  # a shared edge goes
    assert area(K.united([square(0, 0), square(1, 0.5), square(2, 0)])) == [3.0]  # half of one
    assert area(K.united([square(0, 0), square(0, 0)])) == [1.0] and area(K.united([square(0, 0, 3), square(1, 1)])) == [9.0]
    assert area(K.united([square(0, 0, 3), square(0, 1)])) == [9.0]  # inside, along an edge
    assert area(K.united([square(0, 0), square(5, 5, 2)])) == [4.0, 1.0]
    assert sum(area(K.united([square(0, 0), square(1, 1)]))) == 2.0  # a shared corner
    frame = [square(0, 0, 1), line((0, 1), (1, 1), (1, 3), (0, 3), (0, 1)), line((1, 2), (3, 2), (3, 3), (1, 3), (1, 2)), line((2, 0), (3, 0), (3, 2), (2, 2), (2, 0)), line((1, 0), (2, 0), (2, 1), (1, 1), (1, 0))]
    assert area(K.united(frame)) == [9.0]  # the hole in its middle is filled


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 12), st.integers(0, 12), st.integers(1, 6)), min_size=1, max_size=6))
def test_unions_hold_what_their_parts_hold(boxes):
    parts = [square(x, y, s) for x, y, s in boxes]
    union = K.united(parts)
    for x in np.arange(0.25, 18, 0.75):
        for y in np.arange(0.25, 18, 0.75):
            p = np.array((x, y))
            if any(K.in_ring(p, r) for r in parts):
                assert any(K.in_ring(p, r) for r in union)
    assert sum(map(K.ring_area, union)) <= sum(map(K.ring_area, parts)) + sum(s * s for *_, s in boxes) + 1e-6


def test_dilated_shapes():
    ell = line((0, 0), (40, 0), (40, 10), (10, 10), (10, 40), (0, 40), (0, 0))
    (wide,) = K.dilated(ell, 2.0)
    # Area, edge length times the distance, five convex corners of a quarter disc and a square lost in the concave one.
    assert abs(K.ring_area(wide) - (700 + 2 * 160 + 5 * math.pi - 4)) < 0.1
    assert not K.in_ring(np.array((20.0, 20.0)), wide) and K.in_ring(np.array((11.5, 11.5)), wide)
    (disc,) = K.dilated(line((3, 4)), 5.0)
    assert abs(K.ring_area(disc) - 25 * math.pi) < 0.2
    two = K.united(K.dilated(line((0, 0)), 5.0) + K.dilated(line((6, 0)), 5.0))
    assert len(two) == 1 and np.allclose(K.pole(two[0], 0.01)[1], 0, atol=0.2)


def test_columns_of_shapes_keep_their_rows():
    import pyarrow as pa

    from voltmesh.operators import shapes

    point = pa.struct([("lon", pa.float64()), ("lat", pa.float64())])
    at = lambda *p: [{"lon": float(x), "lat": float(y)} for x, y in p]
    lines = [at((1, 2), (3, 4)), None, [], at((5, 6))]
    parts = [[at((1, 2)), at((3, 4), (5, 6))], None, [], [[], at((7, 8))]]
    for rows, kind in ((lines, pa.list_(point)), (parts, pa.list_(pa.list_(point)))):
        whole = pa.array(rows, kind)
        assert shapes._column(shapes._rows(whole), kind).to_pylist() == rows
        assert shapes._column(shapes._rows(whole.slice(1, 3)), kind).to_pylist() == rows[1:]
        assert shapes._column([], kind).to_pylist() == []


def test_pole_and_gap_take_few_steps_of_whole_arrays(monkeypatch):
    steps = []
    monkeypatch.setattr(K, "distance_to_path", lambda *x: steps.append(x))
    square = np.array([[0, 0], [2, 0], [2, 2], [0, 2], [0, 0]], float)
    far = [[4.0, 0.0], [6.0, 0.0], [6.0, 2.0], [4.0, 2.0], [4.0, 0.0]]
    assert K.pole(square, 1e-3).tolist() == [1, 1] and K.gap(square, np.array(far)) == 2
    assert K.gap(square, square + 1) == K.gap(square, square * 0.25 + 0.5) == 0 and not steps


def _star(rng, middle):
    """A ring around a place."""
    angle = np.sort(rng.uniform(0, 2 * np.pi, rng.integers(3, 9)))
    ring = middle + rng.uniform(20, 300, (len(angle), 1)) * np.stack([np.cos(angle), np.sin(angle)], 1)
    return np.concatenate([ring, ring[:1]])


def test_many_shapes_at_once_are_as_one_by_one():
    rng = np.random.default_rng(7)
    rings = [_star(rng, rng.uniform(0, 500, 2)) for _ in range(200)] + [np.array([[1.0, 2.0], [3.0, 2.0], [4.0, 2.0], [1.0, 2.0]])]
    assert np.abs(K.poles(rings, 5.0) - np.array([K.pole(r, 5.0) for r in rings])).max() < 1e-6 and K.poles([], 5.0).shape == (0, 2)
    lines = [rng.uniform(0, 600, 2) + np.cumsum(rng.normal(0, 120, (rng.integers(2, 9), 2)), axis=0) for _ in range(200)]
    lines[3] = np.repeat(lines[3], 2, axis=0)
    regions = [[x, rings[i], rings[i + 1], rng.uniform(0, 600, (1, 2))][i % 2 : 2 + i % 3] for i, x in enumerate(lines)]
    for wide in (60.0, 0.0):
        one = [[p for p in K.outside(x, (r, wide)) if K.length(p) > 1e-6] for x, r in zip(lines, regions, strict=True)]
        many = K.outside_each(lines, regions, wide)
        assert [len(x) for x in one] == [len(x) for x in many] and sum(map(len, one)) > 100
        assert all(abs(K.length(p) - K.length(q)) < 1e-6 for x, y in zip(one, many, strict=True) for p, q in zip(x, y, strict=True))


def test_groups_of_links():
    a, b = np.arange(999, 0, -1), np.arange(998, -1, -1)
    assert (K.joined_groups(a, b, 1002) == [0] * 1000 + [1000, 1001]).all()
    assert K.joined_groups(np.array([1, 3, 4]), np.array([3, 4, 1]), 5).tolist() == [0, 1, 2, 1, 1]


def test_the_pole_of_a_square_is_its_middle_at_any_longitude():
    for lon in (9.7, 10.0, 12.34):
        square = np.array([lon, 50.0]) + 3e-4 * np.array([[-1, -1], [1, -1], [1, 1], [-1, 1], [-1, -1]])
        ring = K.to_metric(square)
        for p in (K.pole(ring, 30.0), K.poles([ring], 30.0)[0]):
            assert np.abs(K.to_degrees(p[None])[0] - [lon, 50.0]).max() < 5e-7
