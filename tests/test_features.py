"""Image features on the flat layout against NumPy on nested arrays."""

import hashlib

import numpy as np
import pytest

from quarry.operators import features as feat

SHAPES = [(8, 8, 3), (5, 7, 3), (1, 1, 1), (2, 9, 4), (6, 3, 1)]


def _hash(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:8], 16)


@pytest.fixture(scope="module")
def images(spark):
    rng = np.random.default_rng(5)
    arrays = {i: rng.integers(0, 256, size=SHAPES[i % len(SHAPES)]) for i in range(40)}
    rows = [(i, a.tolist()) for i, a in arrays.items()] + [(100, None), (101, []), (102, [[]])]
    nested = spark.createDataFrame(rows, "id bigint, pixels array<array<array<int>>>")
    return arrays, feat.flat_images(nested)


def _nested(df, order="hwc"):
    return {r["id"]: r["pixels"] for r in feat.nested_images(df, order).collect()}


def test_flat_and_nested_round_trip(images):
    arrays, flat = images
    got = _nested(flat)
    assert all(np.array_equal(got[i], a) for i, a in arrays.items())
    assert got[100] is None and got[101] == [] and got[102] == [[]]


def test_scale_and_normalize_equal_numpy(images):
    arrays, flat = images
    scaled = feat.scale_pixels(flat)
    got = _nested(scaled, "chw")
    assert all(np.array_equal(got[i], a.transpose(2, 0, 1) / 255.0) for i, a in arrays.items())
    mean, std = (0.1, 0.2, 0.3, 0.4), (1.0, 2.0, 3.0, 4.0)
    got = _nested(feat.normalize_channels(scaled, mean, std), "chw")
    for i, a in arrays.items():
        c = a.shape[2]
        want = (a.transpose(2, 0, 1) / 255.0 - np.reshape(mean[:c], (c, 1, 1))) / np.reshape(std[:c], (c, 1, 1))
        assert np.allclose(got[i], want, rtol=1e-15)
    assert got[100] is None


@pytest.mark.parametrize("pad,size", [(1, 8), (4, 3), (0, 5), (2, 40)])
def test_crop_equals_a_slice_of_the_padded_image(images, pad, size):
    arrays, flat = images
    got = _nested(feat.random_crop(flat, pad=pad, size=size, seed=3, epoch=2))
    for i, a in arrays.items():
        oy, ox = (_hash(3, 2, i, axis) % (2 * pad + 1) for axis in "yx")
        want = np.pad(a, ((pad, pad), (pad, pad), (0, 0)))[oy:oy + size, ox:ox + size]
        assert np.array_equal(got[i], want.tolist()), (i, a.shape)
    assert got[100] is None


def test_flip_equals_numpy_and_cells_name_their_place(images):
    arrays, flat = images
    flipped = feat.random_flip(flat, p=0.5, seed=3, epoch=2)
    got = _nested(flipped)
    turned = {i for i in arrays if _hash(3, 2, i, "flip") % 1000 < 500}
    assert 0 < len(turned) < len(arrays)
    assert all(np.array_equal(got[i], a[:, ::-1] if i in turned else a) for i, a in arrays.items())
    for order, df, value in (("hwc", flat, lambda v: v), ("chw", feat.scale_pixels(flat), lambda v: v / 255.0)):
        cells = feat.image_cells(df, order).collect()
        assert len(cells) == sum(a.size for a in arrays.values())
        assert all(r["v"] == value(arrays[r["id"]][r["h"], r["w"], r["c"]]) for r in cells)


def test_one_generator_and_no_python(images):
    plan = feat.image_cells(feat.random_crop(images[1], pad=1, size=8))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 1 and "Python" not in plan
