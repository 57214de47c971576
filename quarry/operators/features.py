"""Image features on a flat layout, as array expressions (no Python in the tasks).

An image is ``struct<height int, width int, channels int, cells array<T>>``; raw cells stand
in height x width x channel order, values 0..255, scaled ones in channel x height x width
order. A cell's place is index arithmetic, so padding is never built and an image is one
array. :func:`flat_images` and :func:`nested_images` convert from and to nested arrays.
Random choices come from ``hash_int(seed, epoch, id, tag)``, so an epoch's augmentation is
reproducible and checkable. A null image stays null; one without cells stays without.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_mod

# Fixed per-channel statistics used by the studied image pipeline (RGB, 0..255 scale).
CHANNEL_MEAN_255 = (125.3, 123.0, 113.9)
CHANNEL_STD_255 = (63.0, 62.1, 66.7)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once a row, not once for each cell that a
    lambda inside ``body`` visits."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b).cast("int")


def _image(img: Column, cells: Column, height: Column | None = None, width: Column | None = None) -> Column:
    return F.when(img.isNotNull(), F.struct(
        (img["height"] if height is None else height).alias("height"),
        (img["width"] if width is None else width).alias("width"),
        img["channels"].alias("channels"), cells.alias("cells")))


def flat_images(images: DataFrame, col: str = "pixels") -> DataFrame:
    """Nested H x W x C arrays (all rows of an image equally wide) -> the flat layout."""
    def body(p):
        return F.when(p.isNotNull(), F.struct(
            F.size(p).alias("height"),
            F.coalesce(F.size(F.get(p, F.lit(0))), F.lit(0)).alias("width"),
            F.coalesce(F.size(F.get(F.get(p, F.lit(0)), F.lit(0))), F.lit(0)).alias("channels"),
            F.flatten(F.flatten(p)).alias("cells")))
    return images.withColumn(col, _let(F.col(col), body))


def nested_images(images: DataFrame, order: str = "hwc", col: str = "pixels") -> DataFrame:
    """The flat layout -> nested arrays in ``order`` (``hwc`` raw, ``chw`` scaled)."""
    size = {"h": "height", "w": "width", "c": "channels"}

    def runs(cells, length, count):
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(cells, i * length + 1, length))
                      ).otherwise(F.filter(F.array(cells), lambda _: F.lit(False)))

    def body(img):
        outer, middle, inner = (img[size[x]] for x in order)
        return F.when(img.isNotNull(), F.transform(runs(img["cells"], middle * inner, outer), lambda m: runs(m, inner, middle)))
    return images.withColumn(col, _let(F.col(col), body))


def scale_pixels(images: DataFrame, col: str = "pixels", out: str = "pixels") -> DataFrame:
    """uint8 cells in H x W x C order -> doubles / 255 in C x H x W order."""
    def body(img):
        area = img["height"] * img["width"]
        return _image(img, F.transform(img["cells"], lambda _, k: F.get(
            img["cells"], F.pmod(k, area) * img["channels"] + _div(k, area)).cast("double") / F.lit(255.0)))
    return images.withColumn(out, _let(F.col(col), body))


def normalize_channels(images: DataFrame, mean: Sequence[float] | None = None,
                       std: Sequence[float] | None = None, col: str = "pixels") -> DataFrame:
    """``(x - mean[c]) / std[c]`` on C x H x W doubles (defaults: the fixed statistics / 255)."""
    mean = mean if mean is not None else [m / 255.0 for m in CHANNEL_MEAN_255]
    std = std if std is not None else [s / 255.0 for s in CHANNEL_STD_255]
    m = F.array(*[F.lit(float(v)) for v in mean])
    s = F.array(*[F.lit(float(v)) for v in std])

    def body(img):
        area = img["height"] * img["width"]
        return _image(img, F.transform(img["cells"], lambda x, k: (x - F.get(m, _div(k, area))) / F.get(s, _div(k, area))))
    return images.withColumn(col, _let(F.col(col), body))


def random_crop(images: DataFrame, pad: int = 4, size: int = 32, seed: int = 0, epoch: int = 0,
                col: str = "pixels", key: str = "id") -> DataFrame:
    """Zero-pad by ``pad`` on every side and cut a ``size`` x ``size`` window at a seeded
    offset in ``0 .. 2*pad`` per axis; works on raw H x W x C cells. Each row of the window
    is a slice of the image, with zeros only where the window overhangs. A window that
    reaches beyond the padding ends there."""
    oy = hash_mod(2 * pad + 1, seed, epoch, F.col(key), "y").cast("int")
    ox = hash_mod(2 * pad + 1, seed, epoch, F.col(key), "x").cast("int")
    placed = F.struct(F.col(col).alias("img"), (oy - pad).alias("top"), (ox - pad).alias("left"))

    def measure(v):
        img, left = v["img"], v["left"]
        high = F.greatest(F.least(F.lit(size), img["height"] + pad - v["top"]), F.lit(0))
        wide = F.greatest(F.least(F.lit(size), img["width"] + pad - left), F.lit(0))
        before = F.least(F.greatest(-left, F.lit(0)), wide)
        inner = F.greatest(F.least(left + wide, img["width"]) - F.greatest(left, F.lit(0)), F.lit(0))
        return F.struct(img.alias("img"), v["top"].alias("top"), F.greatest(left, F.lit(0)).alias("start"),
                        high.alias("high"), wide.alias("wide"), before.alias("before"), inner.alias("inner"))

    def body(v):
        img, ch = v["img"], v["img"]["channels"]
        zero = F.get(img["cells"], F.lit(0)) * 0

        def row(i):
            y = v["top"] + i
            own = F.slice(img["cells"], (y * img["width"] + v["start"]) * ch + 1, v["inner"] * ch)
            return F.when((y >= 0) & (y < img["height"]) & (v["inner"] > 0), F.concat(
                F.array_repeat(zero, v["before"] * ch), own,
                F.array_repeat(zero, (v["wide"] - v["before"] - v["inner"]) * ch))
            ).otherwise(F.array_repeat(zero, v["wide"] * ch))

        cells = F.when(v["high"] * v["wide"] * ch > 0, F.flatten(F.transform(F.sequence(F.lit(0), v["high"] - 1), row))
                       ).otherwise(F.filter(img["cells"], lambda _: F.lit(False)))
        return _image(img, cells, v["high"], v["wide"])
    return images.withColumn(col, _let(placed, lambda v: _let(measure(v), body)))


def random_flip(images: DataFrame, p: float = 0.5, seed: int = 0, epoch: int = 0,
                col: str = "pixels", key: str = "id") -> DataFrame:
    """Mirror left-right (raw H x W x C cells) when
    ``hash_int(seed, epoch, id, 'flip') % 1000 < 1000 * p``."""
    flip = hash_mod(1000, seed, epoch, F.col(key), "flip") < F.lit(int(round(1000 * p)))

    def body(img):
        w, ch = img["width"], img["channels"]
        # the cell of pixel x in the same row stands for pixel width - 1 - x
        return _image(img, F.transform(img["cells"], lambda _, k: F.get(
            img["cells"], k + (w - 1 - 2 * F.pmod(_div(k, ch), w)) * ch)))
    return images.withColumn(col, F.when(flip, _let(F.col(col), body)).otherwise(F.col(col)))


def image_cells(images: DataFrame, order: str = "hwc", col: str = "pixels", key: str = "id") -> DataFrame:
    """Long form ``(id, h, w, c, v)`` of an image column (``order`` names its cells' order:
    ``hwc`` for raw pixels, ``chw`` for scaled tensors)."""
    h, w, ch = (F.col(f"_{x}") for x in ("height", "width", "channels"))
    image = F.col(col)
    # the outer form: for the inner one Spark infers a filter that works out every image twice
    cells = images.select(key, *[image[x].alias(f"_{x}") for x in ("height", "width", "channels")],
                          F.posexplode_outer(image["cells"]).alias("_k", "v")).where("_k is not null")
    k = F.col("_k")
    if order == "hwc":
        place = _div(k, w * ch), F.pmod(_div(k, ch), w), F.pmod(k, ch)
    elif order == "chw":
        place = F.pmod(_div(k, w), h), F.pmod(k, w), _div(k, h * w)
    else:
        raise ValueError(f"unknown order {order!r}")
    return cells.select(key, *[x.alias(n) for x, n in zip(place, "hwc")], "v")
