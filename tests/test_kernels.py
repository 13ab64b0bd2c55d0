import itertools

import numpy as np
import pytest

from tidemark.operators import kernels as K
from tidemark.plans.kernels import cameras


def test_assignment_fixture():
    assert K.assignment(np.array([[4.0, 1, 3], [2, 0, 5]])) == [(0, 1), (1, 0)]


@pytest.mark.parametrize("shape", [(1, 1), (3, 3), (4, 2), (2, 5), (5, 5)])
def test_assignment_is_least(shape):
    rng = np.random.default_rng(sum(shape))
    for _ in range(20):
        c = rng.integers(0, 9, shape).astype(float)
        pairs = K.assignment(c)
        small, large = min(shape), max(shape)
        turned = c if shape[0] <= shape[1] else c.T
        best = min(sum(turned[i, p[i]] for i in range(small)) for p in itertools.permutations(range(large), small))
        assert len(pairs) == small
        assert sum(c[r, k] for r, k in pairs) == pytest.approx(best)


def test_triangulation():
    p = np.array([np.diag([1000.0, 1000, 1]) @ np.hstack([np.eye(3), [[-x], [0.0], [0.0]]]) for x in (0.0, 1.0)])
    point, support, residual = K.triangulate(p, np.array([[0.0, 0], [-200, 0]]), np.array([0.9, 0.8]))
    assert support == 2
    np.testing.assert_allclose(point, [0, 0, 5], atol=1e-5)
    np.testing.assert_allclose(residual, 0, atol=1e-5)
    assert K.triangulate(p, np.array([[0.0, 0], [np.nan, 0]]), np.array([0.9, 0.8]))[0] is None


def test_triangulation_resists_an_outlier():
    views, x = cameras(), np.array([0.3, -0.2, 5.0])
    q = views @ np.append(x, 1)
    xy = q[:, :2] / q[:, 2:]
    point, _, _ = K.triangulate(views, xy, np.ones(3))
    np.testing.assert_allclose(point, x, atol=1e-6)


def test_weights_are_of_squared_residuals():
    """Of two cameras that see a point along a line, the mean weighted by confidence is the least squares' answer."""
    eye = np.hstack([np.eye(3), np.zeros((3, 1))])
    far = eye.copy()
    far[1, 3] = -1.0  # tells the depth
    views = np.stack([eye, eye, far])
    xy = np.array([[0.0, 0.0], [1e-3, 0.0], [np.nan, np.nan]])
    xy[2] = (0.0, -0.2)
    point, _, _ = K.triangulate(views, xy, np.array([0.9, 0.3, 0.9]), rounds=0)
    # x / z of the point: the three views' x weighted by 0.9, 0.3 and 0.9
    assert point[0] / point[2] == pytest.approx(0.3 * 1e-3 / 2.1, rel=1e-3)


def test_many_points_equal_one_by_one():
    rng, views = np.random.default_rng(12), cameras()
    x = rng.normal(size=(50, 3)) + [0, 0, 6]
    q = np.einsum("vij,nj->nvi", views[:, :, :3], x) + views[:, :, 3]
    xy = q[:, :, :2] / q[:, :, 2:] + rng.normal(size=(50, 3, 2)) * 3
    c = rng.uniform(0.2, 1, (50, 3))
    xy[3, 1], c[4] = np.nan, 0.1
    points, support, residuals = K.triangulate_many(views, xy, c)
    for i in range(50):
        p, n, r = K.triangulate(views, xy[i], c[i])
        assert n == support[i]
        assert (p is None and np.isnan(points[i]).all()) or np.allclose(p, points[i], atol=1e-6)
        np.testing.assert_allclose(r, residuals[i], atol=1e-6)


def test_pose_errors():
    rng = np.random.default_rng(1)
    t = rng.normal(size=(17, 3))
    plain, scaled, aligned = K.pose_errors(2 * t + 3, t, np.ones(17, bool), 0)
    assert plain > 1 and scaled < 1e-9 and aligned < 1e-9
    a = 0.4
    r = np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1]])
    plain, scaled, aligned = K.pose_errors(1.7 * t @ r.T, t, np.ones(17, bool), 0)
    assert scaled > 1 and aligned < 1e-6
    t[0] = np.nan
    assert K.pose_errors(t, t, np.ones(17, bool), 0) is None


def test_similarity_with_an_outlier():
    rng = np.random.default_rng(2)
    s = rng.normal(size=(20, 3))
    t = 2.5 * s + [1, 2, 3]
    t[-1] += 10
    w = np.ones(20)
    w[-1] = 0.01
    scale, r, shift = K.similarity(s, t, w)
    assert np.abs(scale * s @ r.T + shift - t)[:19].max() < 0.03


def test_smoothing():
    y = np.linspace(0, 1, 50)
    y[1:-1:2] += 0.05
    x = K.smooth(y, np.full(50, 8.0), 0.25)
    assert np.abs(np.diff(x, 2)).sum() < np.abs(np.diff(y, 2)).sum()
    assert np.abs(x - y).max() < 0.1
    d = np.zeros((48, 50))
    for i in range(48):
        d[i, i : i + 3] = 1, -2, 1
    np.testing.assert_allclose(x, np.linalg.solve(8 * np.eye(50) + 0.25 * d.T @ d, 8 * y), atol=1e-6)


def test_clips_keep_to_the_budget():
    c, s = np.zeros(100, bool), np.zeros(100)
    c[[10, 50, 90]], s[[10, 50, 90]] = True, (1, 3, 2)
    out = K.bounded_clips(c, s, 4, 0.1)
    assert out.sum() <= 10 and out[50]
    assert np.flatnonzero(K.bounded_clips(c, s, 15, 0.1)).tolist() == list(range(45, 55))  # cropped around the worst
    assert np.flatnonzero(K.bounded_clips(c, np.ones(100), 2, 0.05)).tolist() == list(range(88, 93))  # of equal ones the later
    s[50] = np.nan
    assert K.bounded_clips(c, s, 4, 0.09)[90]


def test_extrema_are_separated():
    assert K.separated_extrema(np.array([1.0, 5, 4, 0, 5, 3]), 3, 2) == [1, 4]
    assert K.separated_extrema(np.array([1.0, 5, 4, 0, 5, 3]), 1, 2, ascending=True) == [3]
    assert K.separated_extrema(np.array([np.nan, np.nan]), 2, 1) == []


def test_tracking_both_ways():
    rng = np.random.default_rng(3)
    frames, truth = [], []
    for f in range(60):
        a, b = np.array([10 + f, 10, 30 + f, 50]) / 100, np.array([90 - f, 60, 95 - f, 70]) / 100
        order = rng.permutation(2)
        frames.append([(a, b)[i] for i in order])
        truth.append(int(np.argmin(order)))
    for reverse in (False, True):
        best = max(K.track(frames, reverse=reverse), key=len)
        assert len(best) == 60
        assert all(best[f] == truth[f] for f in range(60)) or all(best[f] != truth[f] for f in range(60))


def test_identity_gate_breaks_the_chain():
    a, far = np.array([0, 0, 1, 1.0]), np.array([50, 50, 51, 51.0])
    assert K.identity_gate([a, far, a, None, far]) == [False, True, False, False, False]
    # 0.36 is over the tracker's threshold and under the gate's 0.38
    b = np.array([0.0, 0.0, 0.2, 0.2])
    near = next(b + np.array([x, 0, x, 0]) for x in np.arange(0.05, 0.3, 0.001) if K.box_affinity(b, b + np.array([x, 0, x, 0])) < 0.375)
    assert K.box_affinity(b, near) > K.ASSOCIATION and K.identity_gate([b, near]) == [False, True]


def test_correlation_finds_the_lag():
    x = np.random.default_rng(4).normal(size=200)
    y = np.roll(x, 3)
    r = K.cross_correlation(x, y, 6)
    assert int(np.argmax(r)) - 6 == 3
    assert (K.cross_correlation(np.ones(10), y, 2) == 0).all()
    brute = [np.dot(K.standardized(x)[max(0, -k) : 200 - max(0, k)], K.standardized(y)[max(0, k) : 200 + min(0, k)]) / 200 for k in range(-6, 7)]
    np.testing.assert_allclose(r, brute, atol=1e-9)


def test_mean_rotation_downweights():
    a = 0.1
    turn = np.array([[np.cos(a), -np.sin(a), 0], [np.sin(a), np.cos(a), 0], [0, 0, 1]])
    mean, off = K.mean_rotation(np.array([np.eye(3)] * 6 + [turn]))
    assert off[-1] > 5 and off[0] < 1
    assert np.linalg.det(mean) == pytest.approx(1)


def test_flux_and_jpeg():
    assert len(K.spectral_flux(np.zeros(4), 8, 4)) == 0
    assert K.spectral_flux(np.concatenate([np.zeros(32), np.ones(32)]), 8, 4).max() > 0
    head = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x0b\x08\x00\x10\x00\x20\x01\x01\x11\x00\xff\xd9"
    assert K.jpeg_size(head) == (32, 16)
    assert K.jpeg_size(b"no") is None


def test_bundle_adjustment_finds_the_scene():
    rng = np.random.default_rng(13)
    truth = rng.normal(size=(21, 3)) * 0.5 + [0, 0, 5]
    poses = [(K.rotation(np.array([0, 0.1 * c, 0])), np.array([-0.5 * c, 0.0, 0.1 * c])) for c in range(3)]
    k = np.broadcast_to(np.array([[1000.0, 0, 320], [0, 1000, 240], [0, 0, 1]]), (3, 3, 3))
    camera, point = np.repeat(np.arange(3), 21), np.tile(np.arange(21), 3)
    x = np.einsum("nij,nj->ni", np.array([p[0] for p in poses])[camera], truth[point]) + np.array([p[1] for p in poses])[camera]
    pixel = 1000 * x[:, :2] / x[:, 2:] + [320, 240]
    moved = [poses[0]] + [(K.rotation(np.array([0.01, -0.02, 0.01])) @ r, t + 0.02) for r, t in poses[1:]]
    off = truth + rng.normal(size=truth.shape) * 0.02
    out, points, used, before, after, converged = K.two_stage_adjust(moved, off, k, camera, point, pixel)
    assert np.median(before) > 3 and after.max() < 0.01 and used.all() and converged
    assert np.linalg.norm(out[0][1] - poses[0][1]) == 0
    scale, r, s = K.similarity(points, truth)
    assert np.abs(scale * points @ r.T + s - truth).max() < 1e-2
    pixel[3] += 80
    _, _, used, before, after, _ = K.two_stage_adjust(moved, off, k, camera, point, pixel)
    assert not used[3] and np.median(after[used]) < 0.1 * np.median(before)


def test_derivatives():
    rng = np.random.default_rng(14)
    pose, p = [(K.rotation(rng.normal(size=3) * 0.2), rng.normal(size=3) * 0.1)], np.array([[0.2, -0.1, 4.0]])
    k = np.array([[[900.0, 0, 300], [0, 950, 200], [0, 0, 1]]])
    zero = np.array([0])
    e, by_pose, by_point = K._residuals(pose, p, k, zero, zero, np.zeros((1, 2)))
    for i in range(3):
        d = np.zeros(3)
        d[i] = 1e-6
        turned = K._residuals([(K.rotation(d) @ pose[0][0], pose[0][1])], p, k, zero, zero, np.zeros((1, 2)))[0]
        shifted = K._residuals([(pose[0][0], pose[0][1] + d)], p, k, zero, zero, np.zeros((1, 2)))[0]
        moved = K._residuals(pose, p + d, k, zero, zero, np.zeros((1, 2)))[0]
        np.testing.assert_allclose((turned - e)[0] / 1e-6, by_pose[0, :, i], atol=0.05)
        np.testing.assert_allclose((shifted - e)[0] / 1e-6, by_pose[0, :, 3 + i], atol=0.05)
        np.testing.assert_allclose((moved - e)[0] / 1e-6, by_point[0, :, i], atol=0.05)


@pytest.mark.parametrize("n, most", [(0, 1), (1, 1), (2, 1), (37, 3), (64, 5), (200, 4), (333, 1000)])
def test_dominating_items_are_counted_without_pairs(n, most):
    rng = np.random.default_rng(n)
    order, x, y = rng.integers(0, max(n // 2, 1) if most < 10 else 10**6, n), rng.integers(-most, most, n), rng.integers(0, most, n)
    plain = [sum(order[a] < order[b] and x[a] >= x[b] and y[a] >= y[b] and (x[a] > x[b] or y[a] > y[b]) for a in range(n)) for b in range(n)]
    assert K.earlier_dominating(order, x, y).tolist() == plain


def test_many_scenes_are_adjusted_as_one_by_one():
    """Same steps, same rejections, with bad observations in some of the scenes."""
    rng, n = np.random.default_rng(15), 9
    k = np.broadcast_to(np.array([[1000.0, 0, 320], [0, 1000, 240], [0, 0, 1]]), (3, 3, 3))
    turns = np.array([K.rotation(np.array([0, 0.1 * c, 0])) for c in range(3)])
    shifts = np.array([[-0.5 * c, 0.0, 0.1 * c] for c in range(3)])
    truth = rng.normal(size=(n, 21, 3)) * 0.4 + [0, 0, 5]
    x = truth[:, None] @ turns.transpose(0, 2, 1) + shifts[:, None]
    pixel = 1000 * x[..., :2] / x[..., 2:] + [320, 240] + rng.normal(size=(n, 3, 21, 2)) * 0.3
    pixel[::2, 1, ::6] += 70
    moved = np.concatenate([turns[:1], K.rotation(np.array([0.01, -0.02, 0.01])) @ turns[1:]])
    shifted = shifts + 0.02 * np.arange(3)[:, None]
    whole = lambda a: np.broadcast_to(a, (n, *a.shape))
    _, _, _, used, before, after, converged = K.two_stage_adjust_many(whole(moved), whole(shifted), truth + 0.02, k, pixel)
    camera, point = np.repeat(np.arange(3), 21), np.tile(np.arange(21), 3)
    for i in range(n):
        one = K.two_stage_adjust(list(zip(moved, shifted)), truth[i] + 0.02, k, camera, point, pixel[i].reshape(63, 2))
        assert (one[2] == used[i].ravel()).all() and one[5] == converged[i]
        np.testing.assert_allclose(before[i].ravel(), one[3], atol=1e-9)
        assert np.median(after[i][used[i]]) == pytest.approx(np.median(one[4][one[2]]), rel=1e-5)
