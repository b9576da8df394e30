"""Images as tables.

Three representations:

* pixel table ``(image_id, x, y, argb)``: every step is a Spark column
  expression, aggregate or join (bounding box = ``groupBy().agg(min, max)``);
* tiles ``(image_id, ty, tx, w, h, argb array)``: pixel blocks of a fixed side,
  so an image of any size is many rows of bounded size (crop = intersection of
  tile rectangles);
* image rows (Spark's ``image`` source struct): ``crop_image_rows`` does the
  same per image with numpy inside ``mapInPandas`` (one task per partition
  of images, no per-pixel rows), the fast path for large photo sets.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pandas as pd
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.raster import WHITE_ARGB
from ..session import ship_package

# Fixed values of the crop job: tolerance of "differs from white", the
# margin ratio and the name characters (4th) that select it.
DEFAULT_TOLERANCE = 0.05
MARGIN_RATIO = 0.3
MARGIN_CODES = ("E", "R")
MAX_COLOR_DISTANCE = 510.0

TILE_SIDE = 64  # pixels; no array of the tile functions is longer than its square


def read_images(spark, path: str, recursive: bool = True, invalid: str = "raise") -> DataFrame:
    """Decode every image file under ``path`` (breadth of the tree is
    Spark's file listing). Columns: ``origin, height, width, nChannels,
    mode, data`` (BGR(A), row major). A file that can't be decoded fails the
    job; with ``invalid="report"`` it is a row with height and width -1. Spark's
    file sources skip files of no bytes, so those give no row."""
    rows = (spark.read.format("image").option("recursiveFileLookup", str(recursive).lower())
            .option("dropInvalid", "false").load(path).select("image.*"))
    if invalid == "report":
        return rows
    return rows.withColumn("height", F.when(F.col("height") < 0, F.raise_error(F.concat(
        F.lit("not an image: "), F.col("origin")))).otherwise(F.col("height")))


def channels(argb: Column) -> tuple[Column, Column, Column, Column]:
    """(alpha, red, green, blue) of a signed 32-bit ARGB int."""
    return (F.shiftrightunsigned(argb, 24).bitwiseAND(255), F.shiftright(argb, 16).bitwiseAND(255),
            F.shiftright(argb, 8).bitwiseAND(255), argb.bitwiseAND(255))


def color_distance(a: Column, b: Column) -> Column:
    """Euclidean distance over the 4 channels divided by 510."""
    ca, cb = channels(a), channels(b)
    sq = [(x - y) * (x - y) for x, y in zip(ca, cb)]
    return F.sqrt(sq[0] + sq[1] + sq[2] + sq[3]) / F.lit(MAX_COLOR_DISTANCE)


def outside_tolerance(a: Column, b: Column, tolerance: float = DEFAULT_TOLERANCE) -> Column:
    """True when the colours differ by more than ``tolerance`` (the
    reference names this "within tolerance" but means the opposite)."""
    return color_distance(a, b) > F.lit(float(tolerance))


def content_bbox(pixels: DataFrame, image_col: str = "image_id",
                 tolerance: float = DEFAULT_TOLERANCE, base_argb: int = WHITE_ARGB) -> DataFrame:
    """Box of pixels differing from white: ``top_x, top_y, bottom_x,
    bottom_y`` (inclusive), plus ``width, height`` of the image. An image
    with no such pixel gets a NULL box. One aggregation with conditional
    min/max (map-side partial, one exchange)."""
    content = outside_tolerance(F.lit(base_argb), F.col("argb"), tolerance)
    return pixels.groupBy(image_col).agg(
        (F.max("x") + 1).alias("width"), (F.max("y") + 1).alias("height"),
        F.min(F.when(content, F.col("x"))).alias("top_x"),
        F.min(F.when(content, F.col("y"))).alias("top_y"),
        F.max(F.when(content, F.col("x"))).alias("bottom_x"),
        F.max(F.when(content, F.col("y"))).alias("bottom_y"))


def margin_ratio(name: Column) -> Column:
    """I4: 0.3 when the 4th character of the file name is E or R, else 0."""
    return F.when(F.substring(name, 4, 1).isin(*MARGIN_CODES), F.lit(MARGIN_RATIO)).otherwise(F.lit(0.0))


def crop_size(bbox: DataFrame, ratio: Column) -> DataFrame:
    """I4: margins = truncated box size x ratio; new size = box + 2 margins.
    A NULL box keeps the image size and no margin."""
    bw = F.col("bottom_x") - F.col("top_x") + 1
    bh = F.col("bottom_y") - F.col("top_y") + 1
    mx = (bw * ratio).cast("int")
    my = (bh * ratio).cast("int")
    return (bbox.withColumn("margin_x", F.coalesce(mx, F.lit(0)))
            .withColumn("margin_y", F.coalesce(my, F.lit(0)))
            .withColumn("new_width", F.coalesce(bw + 2 * mx, F.col("width")))
            .withColumn("new_height", F.coalesce(bh + 2 * my, F.col("height"))))


def pixel_tiles(pixels: DataFrame, image_col: str = "image_id", side: int = TILE_SIDE) -> DataFrame:
    """Pixel table -> tiles of ``side`` x ``side`` pixels (less at the right and
    lower edge): ``image_col, ty, tx, w, h, argb`` (an array, row after row). One
    shuffle by (image, tile), so one large image is spread over all tasks. A tile
    that lacks a pixel or has one twice fails the job."""
    at = F.struct("y", "x", "argb")
    t = (pixels.groupBy(image_col, F.expr(f"y div {int(side)}").cast("int").alias("ty"),
                        F.expr(f"x div {int(side)}").cast("int").alias("tx"))
         .agg(F.array_sort(F.collect_list(at)).alias("_px"),
              (F.max("x") % side + 1).alias("w"), (F.max("y") % side + 1).alias("h")))
    # sorted by (y, x), pixel i of a whole tile lies in row i div w and column i % w
    whole = (F.size("_px") == F.col("w") * F.col("h")) & F.forall(
        F.transform("_px", lambda p, i: ((p["y"] % side) * F.col("w") + p["x"] % side) == i), lambda ok: ok)
    argb = F.when(whole, F.col("_px.argb")).otherwise(F.raise_error(F.lit("a tile needs one row for each pixel")))
    return t.select(image_col, "ty", "tx", "w", "h", argb.alias("argb"))


def tile_bbox(tiles: DataFrame, image_col: str = "image_id", side: int = TILE_SIDE,
              tolerance: float = DEFAULT_TOLERANCE, base_argb: int = WHITE_ARGB) -> DataFrame:
    """I3 over tiles: the columns of ``content_bbox``. Each tile gives its own
    box inside its row, and the boxes of an image are joined by min and max."""
    content = F.filter(F.transform("argb", lambda v, i: F.when(outside_tolerance(F.lit(base_argb), v, tolerance), i)),
                       lambda i: i.isNotNull())
    t = tiles.select(image_col, "ty", "tx", "w", "h", content.alias("_in"))
    xs = F.transform("_in", lambda i: F.col("tx") * side + i % F.col("w"))
    first, last = F.element_at("_in", 1), F.element_at("_in", -1)
    some = F.size("_in") > 0
    row = lambda i: F.col("ty") * side + F.floor(i / F.col("w")).cast("int")
    return t.groupBy(image_col).agg(
        F.max(F.col("tx") * side + F.col("w")).alias("width"), F.max(F.col("ty") * side + F.col("h")).alias("height"),
        F.min(F.array_min(xs)).alias("top_x"), F.min(F.when(some, row(first))).alias("top_y"),
        F.max(F.array_max(xs)).alias("bottom_x"), F.max(F.when(some, row(last))).alias("bottom_y"))


def _canvas(sizes: DataFrame, image_col: str, side: int) -> DataFrame:
    """The tiles of each new image (``cy, cx``, from ``y0, x0``, of ``ch`` x ``cw``)
    and its content: ``l, t, r, b`` in the old image, moved by ``dx, dy``."""
    s = sizes.select(
        image_col, "width", "height", "new_width", "new_height",
        F.coalesce("top_x", F.lit(0)).alias("l"), F.coalesce("top_y", F.lit(0)).alias("t"),
        F.coalesce("bottom_x", F.col("width") - 1).alias("r"), F.coalesce("bottom_y", F.col("height") - 1).alias("b"),
        (F.col("margin_x") - F.coalesce("top_x", F.lit(0))).alias("dx"),
        (F.col("margin_y") - F.coalesce("top_y", F.lit(0))).alias("dy"))
    s = s.withColumn("cy", F.explode(F.expr(f"sequence(0, cast((new_height - 1) div {side} as int))")))
    s = s.withColumn("cx", F.explode(F.expr(f"sequence(0, cast((new_width - 1) div {side} as int))")))
    return (s.withColumn("y0", F.col("cy") * side).withColumn("x0", F.col("cx") * side)
            .withColumn("ch", F.least(F.lit(side), F.col("new_height") - F.col("y0")))
            .withColumn("cw", F.least(F.lit(side), F.col("new_width") - F.col("x0"))))


def _pieces(tiles: DataFrame, canvas: DataFrame, image_col: str, side: int) -> DataFrame:
    """What each canvas tile takes from each old tile: ``py, px`` (place on the
    canvas), ``pw`` and ``argb`` row after row. A canvas tile meets four old tiles
    at most. The rectangles come from ``canvas`` alone, so the join is on (image,
    tile) and a large image stays spread; a tile that isn't there fails the job."""
    m = (canvas.withColumn("sl", F.greatest("l", F.col("x0") - F.col("dx")))
         .withColumn("sr", F.least("r", F.col("x0") + F.col("cw") - 1 - F.col("dx")))
         .withColumn("st", F.greatest("t", F.col("y0") - F.col("dy")))
         .withColumn("sb", F.least("b", F.col("y0") + F.col("ch") - 1 - F.col("dy")))
         .where("sl <= sr AND st <= sb")
         .withColumn("ty", F.explode(F.expr(f"sequence(cast(st div {side} as int), cast(sb div {side} as int))")))
         .withColumn("tx", F.explode(F.expr(f"sequence(cast(sl div {side} as int), cast(sr div {side} as int))")))
         .select(image_col, "cy", "cx", "ty", "tx", "dx", "dy",
                 F.least(F.lit(side), F.col("width") - F.col("tx") * side).alias("_w"),
                 F.least(F.lit(side), F.col("height") - F.col("ty") * side).alias("_h"),
                 F.greatest("sl", F.col("tx") * side).alias("sl"),
                 F.least("sr", F.col("tx") * side + side - 1).alias("sr"),
                 F.greatest("st", F.col("ty") * side).alias("st"),
                 F.least("sb", F.col("ty") * side + side - 1).alias("sb")))
    got = m.join(tiles, [image_col, "ty", "tx"], "left")
    px = F.when((F.col("w") == F.col("_w")) & (F.col("h") == F.col("_h")), F.col("argb")).otherwise(
        F.raise_error(F.lit("an image needs one row for each pixel")))
    got = got.withColumn("_px", px).withColumn("pw", F.col("sr") - F.col("sl") + 1)
    rows = F.transform(F.sequence(F.col("st"), F.col("sb")), lambda y: F.slice(
        F.col("_px"), (y % side) * F.col("_w") + F.col("sl") % side + 1, F.col("pw")))
    return got.select(image_col, "cy", "cx", (F.col("st") + F.col("dy")).alias("py"),
                      (F.col("sl") + F.col("dx")).alias("px"), "pw", F.flatten(rows).alias("argb"))


def crop_tiles(tiles: DataFrame, sizes: DataFrame, image_col: str = "image_id", side: int = TILE_SIDE,
               base_argb: int = WHITE_ARGB) -> DataFrame:
    """I5 from tiles to tiles: the new images as ``image_col, ty, tx, w, h, argb``.
    Old tiles are cut to the parts that canvas tiles take, and a canvas tile is
    put together from four parts at most; no array is longer than a tile."""
    canvas = _canvas(sizes, image_col, side)
    parts = (_pieces(tiles, canvas, image_col, side).groupBy(image_col, "cy", "cx")
             .agg(F.collect_list(F.struct("py", "px", "pw", "argb")).alias("_parts")))
    c = canvas.select(image_col, "cy", "cx", "y0", "x0", "cw", "ch").join(parts, [image_col, "cy", "cx"], "left")

    def point(i):
        y, x = F.col("y0") + F.floor(i / F.col("cw")).cast("int"), F.col("x0") + i % F.col("cw")
        there = F.filter("_parts", lambda p: (x >= p["px"]) & (x < p["px"] + p["pw"]) & (y >= p["py"])
                         & (y < p["py"] + F.size(p["argb"]) / p["pw"]))
        v = F.transform(there, lambda p: F.get(p["argb"], (y - p["py"]) * p["pw"] + x - p["px"]))
        return F.coalesce(F.get(v, F.lit(0)), F.lit(base_argb))

    argb = F.transform(F.sequence(F.lit(0), F.col("cw") * F.col("ch") - 1), point)
    return c.select(image_col, F.col("cy").alias("ty"), F.col("cx").alias("tx"), F.col("cw").alias("w"),
                    F.col("ch").alias("h"), argb.alias("argb"))


def tile_pixels(tiles: DataFrame, image_col: str = "image_id", side: int = TILE_SIDE) -> DataFrame:
    """Tiles -> pixel table ``(image_col, x, y, argb)``."""
    return (tiles.select(image_col, "ty", "tx", "w", F.posexplode("argb").alias("_i", "argb"))
            .select(image_col, (F.col("tx") * side + F.col("_i") % F.col("w")).alias("x"),
                    (F.col("ty") * side + F.floor(F.col("_i") / F.col("w")).cast("int")).alias("y"), "argb"))


def crop_image(pixels: DataFrame, sizes: DataFrame, image_col: str = "image_id",
               base_argb: int = WHITE_ARGB, side: int = TILE_SIDE) -> DataFrame:
    """White canvas of the new size with the box content placed at
    ``(margin_x, margin_y)`` (inclusive box edges). An image with no box is
    passed through; a NULL pixel takes the base colour; images without an id are
    left out. Output pixel table ``(image_id, x, y, argb)``: the parts cut from
    the tiles, and the canvas points around the content, which need no join."""
    canvas = _canvas(sizes, image_col, side)
    inner = (_pieces(pixel_tiles(pixels, image_col, side), canvas, image_col, side)
             .select(image_col, "py", "px", "pw", F.posexplode("argb").alias("_i", "argb"))
             .select(image_col, (F.col("px") + F.col("_i") % F.col("pw")).alias("x"),
                     (F.col("py") + F.floor(F.col("_i") / F.col("pw")).cast("int")).alias("y"),
                     F.coalesce("argb", F.lit(base_argb)).alias("argb")))
    around = (canvas.where(F.col(image_col).isNotNull())
              .withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("cw") * F.col("ch") - 1)))
              .withColumn("x", F.col("x0") + F.col("_i") % F.col("cw"))
              .withColumn("y", F.col("y0") + F.floor(F.col("_i") / F.col("cw")).cast("int"))
              .where(~(F.col("x") - F.col("dx")).between(F.col("l"), F.col("r"))
                     | ~(F.col("y") - F.col("dy")).between(F.col("t"), F.col("b")))
              .select(image_col, "x", "y", F.lit(base_argb).alias("argb")))
    return inner.unionByName(around)


def photo_routing(files: DataFrame, name_col: str = "name") -> DataFrame:
    """folder = first 3 chars, new name = first 11 chars + ``.jpg``; the
    first file by name keeps each new name, later ones are dropped.
    A new name's first file is the one that equals its ``min(name)``: the join is
    on both names, so files of one new name are spread over many keys."""
    f = files.select(F.col(name_col).alias("name"),
                     F.substring(name_col, 1, 3).alias("folder"),
                     F.concat(F.substring(name_col, 1, 11), F.lit(".jpg")).alias("new_name"))
    first = f.groupBy("new_name").agg(F.min("name").alias("_first"))
    first = first.select("new_name", F.col("_first").alias("name"), F.lit(True).alias("_kept"))
    return (f.join(first, ["new_name", "name"], "left")
            .select("name", "folder", "new_name", F.coalesce("_kept", F.lit(False)).alias("kept")))


# ------------------------------------------------------------ numpy path

def _argb_array(row) -> np.ndarray:
    h, w, nc = int(row["height"]), int(row["width"]), int(row["nChannels"])
    a = np.frombuffer(bytes(row["data"]), dtype=np.uint8).reshape(h, w, nc).astype(np.int64)
    b, g, r = a[..., 0], a[..., 1], a[..., 2]
    alpha = a[..., 3] if nc == 4 else np.full((h, w), 255, dtype=np.int64)
    return (alpha << 24) | (r << 16) | (g << 8) | b


def image_rows_to_pixels(images: DataFrame) -> DataFrame:
    """Image rows -> pixel table ``(origin, x, y, argb)`` (numpy per image)."""
    schema = T.StructType([T.StructField("origin", T.StringType()),
                           T.StructField("x", T.IntegerType()), T.StructField("y", T.IntegerType()),
                           T.StructField("argb", T.IntegerType())])

    def run(batches):
        for pdf in batches:
            parts = []
            for _, row in pdf.iterrows():
                a = _argb_array(row)
                ys, xs = np.indices(a.shape)
                parts.append(pd.DataFrame({"origin": row["origin"], "x": xs.ravel().astype(np.int32),
                                           "y": ys.ravel().astype(np.int32),
                                           "argb": a.ravel().astype(np.uint32).view(np.int32)}))
            yield pd.concat(parts) if parts else pd.DataFrame(columns=schema.fieldNames())

    ship_package(images.sparkSession)
    return images.select("origin", "height", "width", "nChannels", "data").mapInPandas(run, schema)


def crop_image_rows(images: DataFrame, tolerance: float = DEFAULT_TOLERANCE) -> DataFrame:
    """I3-I5 per image with numpy: ``(origin, width, height, top_x, top_y,
    bottom_x, bottom_y, new_width, new_height, argb array<int>)``. The margin
    ratio comes from the file name's 4th character."""
    schema = T.StructType([
        T.StructField("origin", T.StringType()), T.StructField("width", T.IntegerType()),
        T.StructField("height", T.IntegerType()), T.StructField("top_x", T.IntegerType()),
        T.StructField("top_y", T.IntegerType()), T.StructField("bottom_x", T.IntegerType()),
        T.StructField("bottom_y", T.IntegerType()), T.StructField("new_width", T.IntegerType()),
        T.StructField("new_height", T.IntegerType()),
        T.StructField("argb", T.ArrayType(T.IntegerType()))])

    def run(batches):
        for pdf in batches:
            out = []
            for _, row in pdf.iterrows():
                a = _argb_array(row)
                h, w = a.shape
                ch = [(a >> s) & 255 for s in (24, 16, 8, 0)]
                dist = np.sqrt(sum((255 - c) ** 2 for c in ch)) / MAX_COLOR_DISTANCE
                ys, xs = np.nonzero(dist > tolerance)
                name = str(row["origin"]).rsplit("/", 1)[-1]
                ratio = MARGIN_RATIO if len(name) >= 4 and name[3] in MARGIN_CODES else 0.0
                if len(xs) == 0:
                    box = (None, None, None, None)
                    img = a
                else:
                    tx, ty, bx, by = int(xs.min()), int(ys.min()), int(xs.max()), int(ys.max())
                    box = (tx, ty, bx, by)
                    mx, my = int((bx - tx + 1) * ratio), int((by - ty + 1) * ratio)
                    img = np.full((by - ty + 1 + 2 * my, bx - tx + 1 + 2 * mx), WHITE_ARGB, np.int64)
                    img[my:my + by - ty + 1, mx:mx + bx - tx + 1] = a[ty:by + 1, tx:bx + 1]
                flat = (img.ravel() & 0xFFFFFFFF).astype(np.uint32).view(np.int32)
                out.append((row["origin"], w, h, *box, img.shape[1], img.shape[0], flat))
            yield pd.DataFrame(out, columns=schema.fieldNames())

    ship_package(images.sparkSession)
    return images.select("origin", "height", "width", "nChannels", "data").mapInPandas(run, schema)


# ------------------------------------------------------------ image files

def _png(width: int, height: int, pos: np.ndarray, argb: np.ndarray) -> bytes:
    """RGBA PNG of a white canvas with ``argb`` at ``pos`` (y * width + x)."""
    canvas = np.full(height * width, WHITE_ARGB, np.int64).astype(np.uint32)
    canvas[pos] = argb.astype(np.int64).astype(np.uint32)
    rgba = np.stack([canvas >> s for s in (16, 8, 0, 24)], axis=1).astype(np.uint8).reshape(height, width * 4)
    lines = np.concatenate([np.zeros((height, 1), np.uint8), rgba], axis=1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, 6, 0, 0, 0)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes()))
            + chunk(b"IEND", b""))


def encode_png(images: DataFrame) -> DataFrame:
    """``(name, width, height, pos array<int>, argb array<int>)`` -> PNG files
    ``(name, content)``. ``pos`` is y * width + x; pixels not listed are white."""
    def run(batches):
        for pdf in batches:
            yield pd.DataFrame({"name": pdf["name"], "content": [
                _png(int(w), int(h), np.asarray(p, np.int64), np.asarray(a, np.int64))
                for w, h, p, a in zip(pdf["width"], pdf["height"], pdf["pos"], pdf["argb"])]})

    ship_package(images.sparkSession)
    return (images.select("name", "width", "height", "pos", "argb")
            .mapInPandas(run, "name string, content binary"))


def write_files(files: DataFrame, folder: str) -> int:
    """Write each row ``(name, content)`` as a file of ``folder`` (a shared folder
    that pyarrow can open) from the tasks, and return their number. A task that
    runs again overwrites its own files."""
    root = re.sub("^file:/+", "/", folder).rstrip("/")

    def run(batches):
        fs, base = pafs.FileSystem.from_uri(root)
        fs.create_dir(base, recursive=True)
        for pdf in batches:
            for name, content in zip(pdf["name"], pdf["content"]):
                with fs.open_output_stream(f"{base}/{name}") as out:
                    out.write(bytes(content))
            yield pd.DataFrame({"n": [len(pdf)]})

    ship_package(files.sparkSession)
    return files.select("name", "content").mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0
