import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tidepool.functions.raster import WHITE_ARGB
from tidepool.operators import images as IM


def write_png(path, pixels):
    """Minimal RGB PNG writer (test fixture)."""
    h, w = len(pixels), len(pixels[0])
    raw = b"".join(b"\x00" + bytes(v for px in row for v in px) for row in pixels)

    def chunk(kind, data):
        body = kind + data
        return struct.pack(">I", len(data)) + body + struct.pack(">I", zlib.crc32(body) & 0xFFFFFFFF)
    png = (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
           + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))
    path.write_bytes(png)


def _photo(w=6, h=5, block=((2, 4), (1, 3)), color=(10, 20, 30)):
    img = [[(255, 255, 255)] * w for _ in range(h)]
    if block:
        (x0, x1), (y0, y1) = block
        for y in range(y0, y1 + 1):
            for x in range(x0, x1 + 1):
                img[y][x] = color
    return img


def test_scan_bbox_crop(spark, tmp_path):
    d = tmp_path / "ABC"
    d.mkdir()
    write_png(d / "ABCE0001.png", _photo())
    write_png(d / "ABCX0002.png", _photo(block=None))
    imgs = IM.read_images(spark, str(tmp_path))
    assert imgs.count() == 2
    px = IM.image_rows_to_pixels(imgs).withColumnRenamed("origin", "image_id")
    box = {r.image_id.rsplit("/", 1)[-1]: r for r in IM.content_bbox(px).collect()}
    b = box["ABCE0001.png"]
    assert (b.width, b.height, b.top_x, b.top_y, b.bottom_x, b.bottom_y) == (6, 5, 2, 1, 4, 3)
    assert box["ABCX0002.png"].top_x is None
    sizes = IM.crop_size(IM.content_bbox(px).withColumn("name", F.regexp_extract("image_id", "([^/]+)$", 1)),
                         IM.margin_ratio(F.col("name")))
    s = {r.name: r for r in sizes.collect()}
    assert (s["ABCE0001.png"].margin_x, s["ABCE0001.png"].new_width) == (0, 3)  # trunc(3 * 0.3) = 0
    cropped = IM.crop_image(px, sizes)
    e = cropped.where(F.col("image_id").endswith("ABCE0001.png"))
    assert e.count() == 9 and e.where(F.col("argb") == WHITE_ARGB).count() == 0
    assert cropped.where(F.col("image_id").endswith("ABCX0002.png")).count() == 30
    fast = {r.origin.rsplit("/", 1)[-1]: r for r in IM.crop_image_rows(imgs).collect()}
    assert (fast["ABCE0001.png"].new_width, fast["ABCE0001.png"].new_height) == (3, 3)
    assert sorted(fast["ABCE0001.png"].argb) == sorted(r.argb for r in e.collect())
    assert fast["ABCX0002.png"].top_x is None and len(fast["ABCX0002.png"].argb) == 30


def test_margin_ratio_and_distance(spark):
    df = spark.createDataFrame([("ABCE1",), ("ABCR1",), ("ABCX1",)], "n string")
    assert [r[0] for r in df.select(IM.margin_ratio(F.col("n"))).collect()] == [0.3, 0.3, 0.0]
    c = spark.createDataFrame([(-1, -1), (-1, -16777216), (-1, -1 - 20)], "a int, b int")
    got = c.select(IM.outside_tolerance(F.col("a"), F.col("b"), 0.05)).collect()
    assert [r[0] for r in got] == [False, True, False]


def test_photo_routing(spark):
    files = spark.createDataFrame([("ABC12345678x.jpg",), ("ABC12345678a.jpg",), ("XYZ00000000.jpg",)], "name string")
    out = {r.name: (r.folder, r.new_name, r.kept) for r in IM.photo_routing(files).collect()}
    assert out["ABC12345678a.jpg"] == ("ABC", "ABC12345678.jpg", True)
    assert out["ABC12345678x.jpg"][2] is False


def _noise(spark, images):
    """Pixel table of images {id: (w, h, block)} and the same as dicts."""
    rows, want = [], {}
    for name, (w, h, block) in images.items():
        img = _photo(w, h, block, color=None)
        for y in range(h):
            for x in range(w):
                argb = WHITE_ARGB if img[y][x] else -16777216 + 7 * x + 131 * y
                rows.append((name, x, y, argb))
                want[name, x, y] = argb
    return spark.createDataFrame(rows, "image_id string, x int, y int, argb int"), want


def _cropped(images, want, ratio):
    out = {}
    for name, (w, h, block) in images.items():
        (l, r), (t, b) = block or ((0, w - 1), (0, h - 1))
        mx, my = (int((r - l + 1) * ratio), int((b - t + 1) * ratio)) if block else (0, 0)
        for y in range(b - t + 1 + 2 * my):
            for x in range(r - l + 1 + 2 * mx):
                sx, sy = x - mx + l, y - my + t
                out[name, x, y] = want[name, sx, sy] if l <= sx <= r and t <= sy <= b else WHITE_ARGB
    return out


def test_tiles_against_plain_crop(spark):
    images = {"a": (23, 17, ((3, 19), (2, 13))), "b": (8, 8, None), "c": (4, 4, ((0, 3), (0, 3))),
              "d": (1, 1, ((0, 0), (0, 0))), "e": (9, 30, ((8, 8), (5, 29)))}
    px, want = _noise(spark, images)
    tiles = IM.pixel_tiles(px, side=4)
    assert tiles.selectExpr("max(size(argb))").first()[0] == 16
    order = ["image_id", "width", "height", "top_x", "top_y", "bottom_x", "bottom_y"]
    box = IM.content_bbox(px).select(*order)
    assert sorted(map(tuple, IM.tile_bbox(tiles, side=4).select(*order).collect())) == sorted(map(tuple, box.collect()))
    for ratio in (0.0, 0.3):
        sizes = IM.crop_size(box, F.lit(ratio))
        plain = _cropped(images, want, ratio)
        for out in (IM.crop_image(px, sizes, side=4),
                    IM.tile_pixels(IM.crop_tiles(tiles, sizes, side=4), side=4), IM.crop_image(px, sizes)):
            rows = out.collect()
            assert len(rows) == len(plain) and {(r.image_id, r.x, r.y): r.argb for r in rows} == plain
    assert IM.crop_tiles(tiles, sizes, side=4).selectExpr("max(size(argb))").first()[0] <= 16
    assert IM.crop_image(px.limit(0), sizes.limit(0)).count() == 0


def test_tiles_need_every_pixel(spark):
    px, _ = _noise(spark, {"a": (9, 9, ((1, 7), (1, 7)))})
    sizes = IM.crop_size(IM.content_bbox(px), F.lit(0.0))
    hole, tile_gone = px.where("x != 5 OR y != 5"), px.where("x < 4 OR x > 7 OR y > 3")
    for bad in (hole, tile_gone, hole.union(px.where("x = 4 AND y = 5")), px.union(px.where("x = 4 AND y = 5"))):
        with pytest.raises(Exception, match="needs one row for each pixel"):
            IM.crop_image(bad, sizes, side=4).collect()


def test_one_image_is_spread(spark):
    """One image's tiles go to all partitions: no step is keyed by the image alone."""
    px = spark.range(128 * 128).selectExpr("1L AS image_id", "cast(id % 128 as int) x", "cast(id div 128 as int) y",
                                           "cast(-16777216 as int) argb").repartition(8)
    counts = (IM.pixel_tiles(px, side=8).repartition(8, "image_id", "ty", "tx")
              .groupBy(F.spark_partition_id().alias("p")).count().collect())
    assert len(counts) == 8 and max(r["count"] for r in counts) < 128


def test_scan_reports_undecodable(spark, tmp_path):
    write_png(tmp_path / "good.png", _photo())
    (tmp_path / "bad.png").write_bytes(b"not a picture")
    rows = {r.origin.rsplit("/", 1)[-1]: r for r in IM.read_images(spark, str(tmp_path), invalid="report").collect()}
    assert (rows["good.png"].width, rows["bad.png"].width) == (6, -1)
    with pytest.raises(Exception, match="not an image"):
        IM.read_images(spark, str(tmp_path)).collect()


def test_written_png_is_read_back(spark, tmp_path):
    px, want = _noise(spark, {"a": (5, 4, ((1, 3), (0, 3)))})
    rows = px.where(F.col("argb") != WHITE_ARGB).groupBy("image_id").agg(
        F.collect_list(F.col("y") * 5 + F.col("x")).alias("pos"), F.collect_list("argb").alias("argb"))
    files = IM.encode_png(rows.selectExpr("'a.png' AS name", "5 AS width", "4 AS height", "pos", "argb"))
    assert IM.write_files(files, f"file:{tmp_path}/new") == 1 == IM.write_files(files, f"{tmp_path}/new")
    got = IM.image_rows_to_pixels(IM.read_images(spark, f"{tmp_path}/new")).collect()
    assert {("a", r.x, r.y): r.argb for r in got} == want and len(got) == 20
    assert IM.write_files(files.limit(0), f"{tmp_path}/none") == 0
