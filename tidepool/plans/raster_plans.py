"""Driver queries for raster algebra (I7-I20) and images as tables.

Every ``embeddings`` row is an image: its id and label parameterise the
field, its 64 values are its 8x8 bitmap tile. Each image is evaluated on a
40x30 grid, so the work grows with the table. Doubles are rounded to 6
digits on both sides.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import raster as R
from ..operators import images as IM
from ..session import scratch_folder
from ..sources.tables import read_table
from .registry import register

COLS, ROWS = 40, 30
TILE = 8
CUT = 3     # side of the blocks that the photos are cut into
SHEET = 16  # photos on a side of a contact sheet
PI = math.pi
TWO_PI = 2 * PI
# Angles (radians) and sizes of the example pictures; at none of them does a grid
# point fall on a line's edge or a pixel's border.
TILT, LEAN = 0.7, 1.1
CT, ST, CL, SL = math.cos(TILT), math.sin(TILT), math.cos(LEAN), math.sin(LEAN)


def _images(spark, sf_dir):
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "label"])
    return e.select(F.col("vec_id").alias("image_id"), F.col("label"))


def _points(spark, sf_dir, frames=None):
    return R.grid_points(_images(spark, sf_dir), COLS, ROWS, frames)


def _tiles(spark, sf_dir):
    """Every embedding as an 8x8 grey tile in an array, with its grid points."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "label", "embedding"])
    pixel = lambda v: R.grey_argb(R.clamp_intensity(R.to_int_trunc(
        (v.cast("double") + F.lit(0.5)) * F.lit(255.0))))
    images = e.select(F.col("vec_id").alias("image_id"), "label", F.transform("embedding", pixel).alias("tile"))
    return R.grid_points(images, COLS, ROWS)


def _label():
    return F.col("label").cast("double")


def _out(df):
    return df.select("image_id", "col", "row", "value")


def _r6(c):
    return (F.round(c, 6) + F.lit(0.0)).alias("value")


# ------------------------------------------------------------- SQL helpers
_PTS = f"""FROM (SELECT vec_id AS image_id, label, CAST(i % {COLS} AS INTEGER) AS col,
                  CAST((i // {COLS}) % {ROWS} AS INTEGER) AS "row"
             FROM embeddings, range(0, {COLS * ROWS}) g(i)) p"""


def _f(x: float) -> str:
    return repr(float(x))


def _mod(x, y):
    return f"(CASE WHEN ({x}) % ({y}) < 0 THEN ({x}) % ({y}) + ({y}) ELSE ({x}) % ({y}) END)"


def _grid(x, y, cell, line):
    return f"({_mod(x, _f(cell))} >= {_f(line)} AND {_mod(y, _f(cell))} >= {_f(line)})"


def _wave(x, y, phase, vert, amp, period):
    compress = f"({_f(TWO_PI)} / {_f(period)})"
    return (f"({_f(amp)} * cos({compress} * sqrt(({y} - 0.0) * ({y} - 0.0) + ({x} - 0.0) * ({x} - 0.0))"
            f" - ({phase}) * {compress}) + {_f(vert)})")


def _bool_color(b):
    return f"(CASE WHEN {b} THEN -1 ELSE -16777216 END)"


def _trunc_int(x):
    return f"CAST(trunc({x}) AS INTEGER)"


def _grey(v):
    i = f"greatest(least({_trunc_int(f'({v}) * 255.0')}, 255), 0)"
    return f"(-16777216 | ({i} << 16) | ({i} << 8) | {i})"


_C, _R = "CAST(col AS DOUBLE)", 'CAST("row" AS DOUBLE)'
_TILE_SQL = f"""(SELECT vec_id AS image_id, CAST((i - 1) % {TILE} AS INTEGER) AS x,
                        CAST((i - 1) // {TILE} AS INTEGER) AS y,
                        {_grey('CAST(embedding[i] AS DOUBLE) + 0.5')} AS argb
                   FROM embeddings, generate_series(1, len(embedding)) g(i))"""


def _lookup_sql(x, y, extra_cols=""):
    tx = f"(CASE WHEN {_trunc_int(x)} % {TILE} < 0 THEN {_trunc_int(x)} % {TILE} + {TILE} ELSE {_trunc_int(x)} % {TILE} END)"
    ty = f"(CASE WHEN {_trunc_int(y)} % {TILE} < 0 THEN {_trunc_int(y)} % {TILE} + {TILE} ELSE {_trunc_int(y)} % {TILE} END)"
    return f"""SELECT q.image_id{extra_cols}, q.col, q."row", t.argb AS value
FROM (SELECT *, {tx} AS tx, {ty} AS ty {_PTS}) q
LEFT JOIN {_TILE_SQL} t ON t.image_id = q.image_id AND t.x = q.tx AND t.y = q.ty"""


# ---------------------------------------------------------------- pictures

@register("raster_red_image", f"SELECT image_id, col, \"row\", -65536 AS value {_PTS}")
def raster_red_image(spark, sf_dir):
    return _out(R.evaluate(_points(spark, sf_dir), R.constant(R.RED_ARGB)))


@register("raster_grid", f"""
SELECT image_id, col, "row", {_bool_color(_grid(f'({_C} - CAST(image_id % 17 AS DOUBLE))',
                                                f'({_R} - CAST(label AS DOUBLE))', 9, 2))} AS value {_PTS}
""")
def raster_grid(spark, sf_dir):
    p = R.grid(9, 2).seen(R.move((F.col("image_id") % 17).cast("double"), _label()))
    return _out(R.evaluate(_points(spark, sf_dir), R.black_white(p)))


def _turned_sql(x, y, c, s, factor=1.0):
    """(x, y) turned, then over ``factor``."""
    return f"((({x}) * {_f(c)} - ({y}) * {_f(s)}) / {_f(factor)})", f"((({x}) * {_f(s)} + ({y}) * {_f(c)}) / {_f(factor)})"


_SRG_X, _SRG_Y = _turned_sql(f"({_C} - CAST(label AS DOUBLE) - 0.37)", f"({_R} - 0.61)", CT, ST, 1.6)


@register("raster_scaled_rotated_grid", f"""
SELECT image_id, col, "row", {_bool_color(_grid(_SRG_X, _SRG_Y, 9, 2))} AS value {_PTS}
""")
def raster_scaled_rotated_grid(spark, sf_dir):
    p = R.grid(9, 2).seen(R.move(_label() + 0.37, 0.61), R.turn(TILT), R.zoom(1.6))
    return _out(R.evaluate(_points(spark, sf_dir), R.black_white(p)))


def _two_waves_sql(x, y, p1="0.0", p2="0.0"):
    return (f"({_wave(f'(({x}) - 31.0)', f'(({y}) - 12.0)', p1, 0.4, 0.25, 23)}"
            f" + {_wave(f'(({x}) - 4.0)', f'(({y}) - 27.0)', p2, 0.15, 0.1, 37)})")


def _two_waves(p1=0.0, p2=0.0):
    a = R.wave(p1, 0.4, 0.25, 23).seen(R.move(31, 12))
    b = R.wave(p2, 0.15, 0.1, 37).seen(R.move(4, 27))
    return R.combined(lambda u, v: u + v, a, b)


_WI = _two_waves_sql(f"({_C} - CAST(label AS DOUBLE) * 3.0)", f"({_R} - CAST(image_id % 13 AS DOUBLE))")


@register("raster_wave_image", f"""
SELECT image_id, col, "row", round({_WI}, 6) + 0.0 AS value, {_grey(_WI)} AS argb {_PTS}
""")
def raster_wave_image(spark, sf_dir):
    p = _two_waves().seen(R.move(_label() * 3.0, (F.col("image_id") % 13).cast("double")))
    pts = R.evaluate(_points(spark, sf_dir), p, value_col="_v")
    shade = R.grey(R.constant(F.col("_v")))
    return R.evaluate(pts, shade, value_col="argb").select("image_id", "col", "row", _r6(F.col("_v")), "argb")


_WA = _two_waves_sql(_C, _R, "CAST(label AS DOUBLE) * 1.5", "CAST(label AS DOUBLE) * 0.5")


@register("raster_wave_animation", f"""
SELECT image_id, col, "row", round({_WA}, 6) + 0.0 AS value {_PTS}
""")
def raster_wave_animation(spark, sf_dir):
    p = _two_waves(_label() * 1.5, _label() * 0.5)
    return R.evaluate(_points(spark, sf_dir), p, value_col="_v").select(
        "image_id", "col", "row", _r6(F.col("_v")))


@register("raster_frames", f"""
SELECT image_id, t, col, "row",
       round({_two_waves_sql(_C, _R, 'CAST(t AS DOUBLE) * 2.5', 'CAST(t AS DOUBLE) * 0.75')}, 6) + 0.0 AS value
FROM (SELECT vec_id AS image_id, CAST(i % {COLS} AS INTEGER) AS col,
             CAST((i // {COLS}) % {ROWS} AS INTEGER) AS "row", CAST(i // {COLS * ROWS} AS INTEGER) AS t
        FROM embeddings, range(0, {COLS * ROWS * 3}) g(i)) p
""")
def raster_frames(spark, sf_dir):
    t = F.col("t").cast("double")
    pts = R.grid_points(_images(spark, sf_dir), COLS, ROWS, frames=3)
    return R.evaluate(pts, _two_waves(t * 2.5, t * 0.75), value_col="_v").select(
        "image_id", "t", "col", "row", _r6(F.col("_v")))


def _around_sql(x, y, cx, cy, inner):
    """``inner`` on the coordinates relative to (cx, cy)."""
    ix, iy = inner(f"(({x}) - {_f(cx)})", f"(({y}) - {_f(cy)})")
    return f"(({ix}) + {_f(cx)})", f"(({iy}) + {_f(cy)})"


def _wave_zoom_sql(x, y, phase, lift, height, period, cx, cy):
    def inner(qx, qy):
        s = _wave(qx, qy, phase, lift, height, period)
        return f"(({qx}) / {s})", f"(({qy}) / {s})"
    return _around_sql(x, y, cx, cy, inner)


_GW_X, _GW_Y = _wave_zoom_sql(_C, _R, "CAST(label AS DOUBLE) * 0.7", 1.25, 0.4, 61, 17.3, 11.9)


@register("raster_grid_wave", f"""
SELECT image_id, col, "row", {_bool_color(_grid(_GW_X, _GW_Y, 9, 2))} AS value {_PTS}
""")
def raster_grid_wave(spark, sf_dir):
    bend = R.Warp(R.wave(_label() * 0.7, 1.25, 0.4, 61), "zoom")
    return _out(R.evaluate(_points(spark, sf_dir), R.black_white(R.grid(9, 2).seen(bend, about=(17.3, 11.9)))))


_RA_X, _RA_Y = _around_sql(f"({_C} - CAST(label AS DOUBLE))", f"({_R} - 0.0)", 18.7, 13.2,
                           lambda x, y: _turned_sql(x, y, CL, SL))


@register("raster_rotate_about", f"""
SELECT image_id, col, "row", {_bool_color(_grid(_RA_X, _RA_Y, 7, 2))} AS value {_PTS}
""")
def raster_rotate_about(spark, sf_dir):
    p = R.grid(7, 2).seen(R.turn(LEAN), about=(18.7, 13.2)).seen(R.move(_label(), 0.0))
    return _out(R.evaluate(_points(spark, sf_dir), R.black_white(p)))


_SA_X, _SA_Y = _around_sql(f"({_C} - CAST(label AS DOUBLE))", f"({_R} - 0.0)", 18.7, 13.2,
                           lambda x, y: (f"(({x}) / 1.37)", f"(({y}) / 1.37)"))


@register("raster_scale_about", f"""
SELECT image_id, col, "row", {_bool_color(_grid(_SA_X, _SA_Y, 7, 2))} AS value {_PTS}
""")
def raster_scale_about(spark, sf_dir):
    p = R.grid(7, 2).seen(R.zoom(1.37), about=(18.7, 13.2)).seen(R.move(_label(), 0.0))
    return _out(R.evaluate(_points(spark, sf_dir), R.black_white(p)))


@register("raster_combine_many", f"""
SELECT image_id, col, "row", round(
    {_wave(f'({_C} - 9.0)', f'({_R} - 6.0)', 'CAST(label AS DOUBLE)', 0.4, 0.25, 23)}
  + {_wave(f'({_C} - 26.0)', f'({_R} - 19.0)', '0.0', 0.15, 0.1, 37)}
  + {_wave(f'({_C} - 0.0)', f'({_R} - 0.0)', '0.0', 0.05, 0.35, 19)}, 6) + 0.0 AS value {_PTS}
""")
def raster_combine_many(spark, sf_dir):
    """Three pictures folded in list order, in one projection."""
    waves = [R.wave(_label(), 0.4, 0.25, 23).seen(R.move(9, 6)), R.wave(0.0, 0.15, 0.1, 37).seen(R.move(26, 19)),
             R.wave(0.0, 0.05, 0.35, 19)]
    p = R.folded(waves, lambda a, b: a + b)
    return R.evaluate(_points(spark, sf_dir), p, value_col="_v").select("image_id", "col", "row", _r6(F.col("_v")))


# ------------------------------------------------------------------ bitmaps

def _bitmap(spark, sf_dir, *steps, about=None):
    """The image's own tile, looked up in its array: no join, no shuffle."""
    p = R.tile(F.col("tile"), TILE, TILE)
    for s in steps:
        p = p.seen(*s) if isinstance(s, tuple) else p.seen(s, about=about if isinstance(s, R.Warp) else None)
    return _out(R.evaluate(_tiles(spark, sf_dir), p))


@register("raster_bitmap", _lookup_sql(_C, _R))
def raster_bitmap(spark, sf_dir):
    return _bitmap(spark, sf_dir)


_OFF_C, _OFF_R = f"({_C} - 0.37)", f"({_R} - 0.61)"
_SRB_X, _SRB_Y = _turned_sql(_OFF_C, _OFF_R, CT, ST, 0.3)


@register("raster_scaled_rotated_bitmap", _lookup_sql(_SRB_X, _SRB_Y))
def raster_scaled_rotated_bitmap(spark, sf_dir):
    return _bitmap(spark, sf_dir, (R.move(0.37, 0.61), R.turn(TILT), R.zoom(0.3)))


_BW_X, _BW_Y = _wave_zoom_sql(_C, _R, "CAST(label AS DOUBLE) * 0.7", 1.75, 0.6, 61, 17.3, 11.9)
_BW_X2, _BW_Y2 = _turned_sql(f"({_BW_X} - 0.37)", f"({_BW_Y} - 0.61)", CT, ST, 0.3)


@register("raster_bitmap_wave", _lookup_sql(_BW_X2, _BW_Y2))
def raster_bitmap_wave(spark, sf_dir):
    return _bitmap(spark, sf_dir, (R.move(0.37, 0.61), R.turn(TILT), R.zoom(0.3)),
                   R.Warp(R.wave(_label() * 0.7, 1.75, 0.6, 61), "zoom"), about=(17.3, 11.9))


_TW_SHIFT = _wave(_C, "0.0", "CAST(label AS DOUBLE) * 2.0", 0.1, 7.3, 43)


@register("raster_translate_wave", _lookup_sql(f"({_C} - 0.0)", f"({_R} - {_TW_SHIFT})"))
def raster_translate_wave(spark, sf_dir):
    return _bitmap(spark, sf_dir, R.Warp(R.wave(_label() * 2.0, 0.1, 7.3, 43), "drop"))


# ------------------------------------------------------------- I2-I6 images

def _pixels(spark, sf_dir):
    """Embeddings as 8x8 photos: white background, grey where v > 0.15."""
    e = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    p = e.select(F.col("vec_id").alias("image_id"), F.posexplode("embedding").alias("pos", "v"))
    v = F.col("v").cast("double")
    argb = F.when(v > 0.15, R.grey_argb(R.clamp_intensity(R.to_int_trunc((F.lit(1.0) - v) * F.lit(255.0))))
                  ).otherwise(F.lit(R.WHITE_ARGB))
    return p.select("image_id", (F.col("pos") % TILE).cast("int").alias("x"),
                    (F.col("pos") / TILE).cast("int").alias("y"), argb.alias("argb"))


_PIX_SQL = f"""(SELECT vec_id AS image_id, CAST((i - 1) % {TILE} AS INTEGER) AS x,
        CAST((i - 1) // {TILE} AS INTEGER) AS y,
        CASE WHEN CAST(embedding[i] AS DOUBLE) > 0.15
             THEN {_grey('1.0 - CAST(embedding[i] AS DOUBLE)')} ELSE -1 END AS argb
   FROM embeddings, generate_series(1, len(embedding)) g(i))"""
_DIST_SQL = ("(sqrt(CAST(((((argb >> 24) & 255) - 255) * (((argb >> 24) & 255) - 255)"
             " + (((argb >> 16) & 255) - 255) * (((argb >> 16) & 255) - 255)"
             " + (((argb >> 8) & 255) - 255) * (((argb >> 8) & 255) - 255)"
             " + ((argb & 255) - 255) * ((argb & 255) - 255)) AS DOUBLE)) / 510.0)")


@register("color_distance", f"""
SELECT image_id, x, y, round({_DIST_SQL}, 6) + 0.0 AS dist, {_DIST_SQL} > 0.05 AS outside
FROM {_PIX_SQL} p
""")
def color_distance(spark, sf_dir):
    p = _pixels(spark, sf_dir)
    white = F.lit(R.WHITE_ARGB)
    return p.select("image_id", "x", "y",
                    (F.round(IM.color_distance(white, F.col("argb")), 6) + F.lit(0.0)).alias("dist"),
                    IM.outside_tolerance(white, F.col("argb"), 0.05).alias("outside"))


_BBOX_SQL = f"""
SELECT s.image_id, s.width, s.height, b.top_x, b.top_y, b.bottom_x, b.bottom_y
FROM (SELECT image_id, max(x) + 1 AS width, max(y) + 1 AS height FROM {_PIX_SQL} p GROUP BY image_id) s
LEFT JOIN (SELECT image_id, min(x) AS top_x, min(y) AS top_y, max(x) AS bottom_x, max(y) AS bottom_y
             FROM {_PIX_SQL} p WHERE {_DIST_SQL} > 0.05 GROUP BY image_id) b
  ON s.image_id = b.image_id
"""


@register("content_bbox", _BBOX_SQL)
def content_bbox(spark, sf_dir):
    return IM.content_bbox(_pixels(spark, sf_dir))


_NAME_SQL = "printf('%03d', image_id % 1000) || substr('ERXQ', CAST(image_id % 4 AS INTEGER) + 1, 1) || image_id || '.jpg'"


def _names():
    return F.concat(F.format_string("%03d", F.col("image_id") % 1000),
                    F.substring(F.lit("ERXQ"), (F.col("image_id") % 4 + 1).cast("int"), 1),
                    F.col("image_id").cast("string"), F.lit(".jpg"))


def _sizes(spark, sf_dir):
    bbox = IM.content_bbox(_pixels(spark, sf_dir)).withColumn("name", _names())
    return IM.crop_size(bbox, IM.margin_ratio(F.col("name")))


_SIZES_SQL = f"""
WITH bb AS ({_BBOX_SQL}),
n AS (SELECT *, {_NAME_SQL} AS name FROM bb),
r AS (SELECT *, CASE WHEN substr(name, 4, 1) IN ('E', 'R') THEN 0.3 ELSE 0.0 END AS ratio FROM n),
m AS (SELECT *, CAST(trunc((bottom_x - top_x + 1) * ratio) AS INTEGER) AS mx,
                CAST(trunc((bottom_y - top_y + 1) * ratio) AS INTEGER) AS my FROM r)
"""


@register("crop_size", _SIZES_SQL + """
SELECT image_id, name, coalesce(mx, 0) AS margin_x, coalesce(my, 0) AS margin_y,
       coalesce(bottom_x - top_x + 1 + 2 * mx, width) AS new_width,
       coalesce(bottom_y - top_y + 1 + 2 * my, height) AS new_height FROM m
""")
def crop_size(spark, sf_dir):
    return _sizes(spark, sf_dir).select("image_id", "name", "margin_x", "margin_y",
                                        "new_width", "new_height")


_CROP_SQL = _SIZES_SQL + f""",
s AS (SELECT *, coalesce(mx, 0) AS margin_x, coalesce(my, 0) AS margin_y,
             coalesce(bottom_x - top_x + 1 + 2 * mx, width) AS new_width,
             coalesce(bottom_y - top_y + 1 + 2 * my, height) AS new_height FROM m),
g AS (SELECT s.*, CAST(i % new_width AS INTEGER) AS x, CAST(i // new_width AS INTEGER) AS y
        FROM s, range(0, new_width * new_height) r(i)),
h AS (SELECT image_id, x, y, coalesce(x - margin_x + top_x, x) AS sx, coalesce(y - margin_y + top_y, y) AS sy,
             top_x, top_y, bottom_x, bottom_y FROM g)
SELECT h.image_id, h.x, h.y, coalesce(p.argb, -1) AS argb
FROM h LEFT JOIN {_PIX_SQL} p
  ON p.image_id = h.image_id AND p.x = h.sx AND p.y = h.sy
 AND (h.top_x IS NULL OR (h.sx BETWEEN h.top_x AND h.bottom_x AND h.sy BETWEEN h.top_y AND h.bottom_y))
"""


@register("crop_image", _CROP_SQL)
def crop_image(spark, sf_dir):
    return IM.crop_image(_pixels(spark, sf_dir), _sizes(spark, sf_dir))


@register("content_bbox_tiles", _BBOX_SQL)
def content_bbox_tiles(spark, sf_dir):
    return IM.tile_bbox(IM.pixel_tiles(_pixels(spark, sf_dir), side=CUT), side=CUT)


@register("crop_image_tiles", _CROP_SQL)
def crop_image_tiles(spark, sf_dir):
    tiles = IM.pixel_tiles(_pixels(spark, sf_dir), side=CUT)
    bbox = IM.tile_bbox(tiles, side=CUT).withColumn("name", _names())
    sizes = IM.crop_size(bbox, IM.margin_ratio(F.col("name")))
    return IM.tile_pixels(IM.crop_tiles(tiles, sizes, side=CUT), side=CUT)


# image files: contact sheets of SHEET x SHEET photos, as PNG in the shared folder
_SHEETS_SQL = f"""
WITH px AS (SELECT image_id // {SHEET * SHEET} AS sheet, image_id % {SHEET * SHEET} AS slot, x, y, argb FROM {_PIX_SQL} p),
put AS (SELECT sheet, CAST((slot % {SHEET}) * {TILE} + x AS INTEGER) AS x,
              CAST((slot // {SHEET}) * {TILE} + y AS INTEGER) AS y, argb FROM px),
g AS (SELECT sheet, CAST(i % {SHEET * TILE} AS INTEGER) AS x, CAST(i // {SHEET * TILE} AS INTEGER) AS y
        FROM (SELECT DISTINCT sheet FROM px) s, range(0, {(SHEET * TILE) ** 2}) r(i))
"""


@register("image_scan", _SHEETS_SQL + f"""
SELECT 'sheet-' || g.sheet || '.png' AS name, {SHEET * TILE} AS width, {SHEET * TILE} AS height, g.x, g.y,
       coalesce(put.argb, -1) AS argb
FROM g LEFT JOIN put ON put.sheet = g.sheet AND put.x = g.x AND put.y = g.y
UNION ALL
SELECT DISTINCT 'broken-' || sheet || '.png', -1, -1, CAST(NULL AS INTEGER), CAST(NULL AS INTEGER),
       CAST(NULL AS INTEGER) FROM px
""")
def image_scan(spark, sf_dir):
    """Writes every photo into contact sheets (PNG) with a broken file beside each,
    then scans the folder: pixels of what can be decoded, a row for what can't."""
    n, edge = SHEET * SHEET, SHEET * TILE
    slot = F.col("image_id") % n
    row, col = F.floor(slot / SHEET) * TILE + F.col("y"), slot % SHEET * TILE + F.col("x")
    sheets = (_pixels(spark, sf_dir)
              .select(F.floor(F.col("image_id") / n).alias("sheet"),
                      F.struct((row * edge + col).cast("int").alias("pos"), "argb").alias("p"))
              .groupBy("sheet").agg(F.collect_list("p").alias("p")))
    png = IM.encode_png(sheets.select(
        F.concat(F.lit("sheet-"), "sheet", F.lit(".png")).alias("name"), F.lit(edge).alias("width"),
        F.lit(edge).alias("height"), F.col("p.pos").alias("pos"), F.col("p.argb").alias("argb")))
    broken = sheets.select(F.concat(F.lit("broken-"), "sheet", F.lit(".png")).alias("name"),
                           F.lit("no picture").cast("binary").alias("content"))
    folder = scratch_folder(spark, "image-scan")
    IM.write_files(png.unionByName(broken), folder)
    found = IM.read_images(spark, folder, invalid="report")
    name = F.regexp_extract("origin", "([^/]+)$", 1).alias("name")
    good, bad = found.where("height >= 0"), found.where("height < 0")
    size = good.select("origin", "width", "height")
    px = IM.image_rows_to_pixels(good).join(size, "origin")
    none = F.lit(None).cast("int")
    return (px.select(name, "width", "height", "x", "y", "argb")
            .unionByName(bad.select(name, "width", "height", none.alias("x"), none.alias("y"), none.alias("argb"))))


@register("photo_routing", """
WITH f AS (SELECT upper(replace(p_name, ' ', '_')) || '_' || p_partkey AS name FROM part),
g AS (SELECT name, substr(name, 1, 3) AS folder, substr(name, 1, 11) || '.jpg' AS new_name FROM f)
SELECT name, folder, new_name, name = min(name) OVER (PARTITION BY new_name) AS kept FROM g
""")
def photo_routing(spark, sf_dir):
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name"])
    files = p.select(F.concat(F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit("_"))), F.lit("_"),
                              F.col("p_partkey").cast("string")).alias("name"))
    return IM.photo_routing(files)
