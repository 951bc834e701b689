"""Page images to ink profiles. An image is reduced to about its width plus its height in numbers; pixels never become rows.

A task holds one batch of images, which Spark keeps to spark.sql.execution.arrow.maxBytesPerBatch (64 MB) or one image.
Images of one shape in a batch are reduced together, up to SLAB bytes of them. Joins never broadcast images,
whatever size Spark guesses: they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from airgrid.operators import profile
from airgrid.storage import cut

INK, TOP, BOTTOM, NOISE = 180, 0.08, 0.02, 0.02
#: Bytes of images that are reduced at once, and rows of a batch of results, both of them or one image.
SLAB, ROWS = 1 << 20, 50_000
SHAPE = ("height", "width", "nChannels")


def read_images(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.format("image").load(path).select("image.*")
    return df.select(F.col("origin").alias("page_id"), "height", "width", "nChannels", "data")


def raster(rows: Column) -> Column:
    """binary: the pixels of an image from the hexadecimal digits of its rows, array<string>, from the top."""
    return F.unhex(F.array_join(rows, ""))


def pixels(height: int, width: int, channels: int, data: list) -> np.ndarray:
    """images x height x width x channels, in the order blue, green, red, from the bytes of each image."""
    a = [np.frombuffer(d, dtype=np.uint8).reshape(height, width, channels) for d in data]
    return np.stack(a) if len(a) > 1 else a[0][None]


def _dark(bgr: np.ndarray) -> np.ndarray:
    """True where the grey of a pixel (Rec. 601) is below INK."""
    return bgr @ np.array([0.114, 0.587, 0.299]) < INK


_DARK_GREYS = _dark(np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, axis=1))


def ink(images: np.ndarray) -> np.ndarray:
    """True where a pixel is ink; less than three channels are grey by their first one."""
    return _dark(images[..., :3]) if images.shape[-1] >= 3 else _DARK_GREYS[images[..., 0]]


def _profile(images: DataFrame, of_images, schema: str, more: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, *schema): of_images gives for each slab of images, with the values of `more`, the place of each row's image, and the columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, data = b.column("page_id"), b.column("data")
            places: dict[tuple[int, int, int], list[int]] = {}
            for i, shape in enumerate(zip(*(b.column(k).to_pylist() for k in SHAPE), strict=True)):
                places.setdefault(shape, []).append(i)
            for (h, w, c), every in places.items():
                most = max(1, SLAB // max(1, h * w * c))
                for first in range(0, len(every), most):
                    of = np.array(every[first : first + most])
                    slab = pixels(h, w, c, [data[i].as_buffer() for i in of.tolist()])
                    at, columns = of_images(slab, *(b.column(m).take(pa.array(of)).to_pylist() for m in more))
                    for k in range(0, len(at), ROWS):
                        own = [ids.take(pa.array(of[at[k : k + ROWS]])), *(pa.array(x[k : k + ROWS], t) for x, t in zip(columns, types[1:], strict=True))]
                        yield pa.RecordBatch.from_arrays(own, names)

    out = StructType.fromDDL(f"page_id string, {schema}")
    names, types = out.names, [{"string": pa.string(), "int": pa.int32(), "double": pa.float64()}[f.dataType.simpleString()] for f in out]
    return images.select("page_id", "height", "width", "nChannels", "data", *(m for m in more if m not in SHAPE)).mapInArrow(run, out)


def margins(height: int) -> tuple[int, int]:
    """The rows from the top and the bottom margin on, rounded half up."""
    return int(height * TOP + 0.5), height - int(height * BOTTOM + 0.5)


PROFILE = "axis string, column_index int, pos int, ink int"


def column_ink_profile(images: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Ink of each x, between the margins at the top and bottom, and the columns of images named in `keep`, of type int."""

    def of_images(a, *kept):
        top, bottom = margins(a.shape[1])
        dark = ink(a[:, top:bottom]).sum(axis=1)
        n, width = dark.shape
        more = (np.repeat(np.array(k), width) for k in kept)
        return np.repeat(np.arange(n), width), [["x"] * dark.size, np.zeros(dark.size, int), np.tile(np.arange(width), n), dark.ravel(), *more]

    return _profile(images, of_images, ", ".join([PROFILE, *(f"{k} int" for k in keep)]), keep)


def columns_of_images(images: DataFrame) -> DataFrame:
    """(page_id, column_index, x, width): columns between gutters, which may hold ink in NOISE of the rows between the margins."""
    height = F.col("height")
    scanned = height - profile.half_up(height * BOTTOM) - profile.half_up(height * TOP)
    most = F.greatest(F.lit(1), profile.half_up(scanned * NOISE))
    inked = column_ink_profile(images, ("height",))
    gutters = profile.merge_close_runs(profile.threshold_runs(inked, F.col("ink") <= most, 5))
    kept = profile.drop_edge_columns(profile.columns_from_gutters(gutters))
    return kept.withColumn("column_index", (F.row_number().over(Window.partitionBy("page_id").orderBy("x")) - 1).cast("int"))


def row_cuts_of_images(images: DataFrame, pages: DataFrame) -> DataFrame:
    """pages (page_id, rows, separator) with height and cuts array<int>, from the images of the pages."""
    columns = cut(columns_of_images(images))
    # Profiles are used by several steps; pixels are read once for them.
    rows = cut(row_ink_profile(images, columns))
    known = cut(pages.hint("shuffle_merge").join(images.select("page_id", "height"), "page_id"))
    return profile.detect_row_cuts(rows, columns, known, TOP, BOTTOM)


def row_ink_profile(images: DataFrame, columns: DataFrame) -> DataFrame:
    """Ink of each y in each of the page's columns (page_id, column_index, x, width)."""
    own = columns.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("column_index", "x", "width"))).alias("cs"))

    def of_images(a, cs):
        height = a.shape[1]
        # Ink up to each x, so that a column is the difference of two; slices of arrays clip alike.
        upto = np.zeros((*a.shape[:2], a.shape[2] + 1), np.int32)
        np.cumsum(ink(a), axis=2, out=upto[:, :, 1:])
        flat = [(i, c["column_index"], *slice(c["x"], c["x"] + c["width"]).indices(a.shape[2])[:2]) for i, own in enumerate(cs) for c in own]
        at, index, start, stop = np.array(flat, dtype=int).reshape(-1, 4).T
        dark = upto[at, :, np.maximum(start, stop)] - upto[at, :, start]
        return np.repeat(at, height), [["y"] * dark.size, np.repeat(index, height), np.tile(np.arange(height), len(at)), dark.ravel()]

    return _profile(images.hint("shuffle_merge").join(own, "page_id"), of_images, PROFILE, ("cs",))


def banner_color_ratio(images: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(page_id, colored_ratio) of the band at the top where the weekday stands, and the columns of images named in `keep`, of type int."""

    def of_images(a, *kept):
        h, w = a.shape[1:3]
        band = a[:, : max(1, int(h * 0.06)), int(w * 0.35) : max(int(w * 0.35) + 1, int(w * 0.9)), : 3 if a.shape[3] >= 3 else 1].astype(np.int16)
        most = band.max(axis=3)
        return np.arange(len(a)), [((most - band.min(axis=3) > 30) & (most > 100)).mean(axis=(1, 2)), *kept]

    return _profile(images, of_images, ", ".join(["colored_ratio double", *(f"{k} int" for k in keep)]), keep)
