"""Geometry and camera arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def hypotenuse(width: Column, height: Column) -> Column:
    return F.sqrt(width.cast("double") * width + height.cast("double") * height)


def polygon_area(coords: Column) -> Column:
    """Shoelace area of ``[x1, y1, x2, y2, ...]``."""
    xs = F.filter(coords, lambda _, i: i % 2 == 0)
    ys = F.filter(coords, lambda _, i: i % 2 == 1)

    def rotated(values):
        return F.concat(F.slice(values, 2, F.greatest(F.size(values) - 1, F.lit(0))), F.slice(values, 1, 1))

    ahead = F.zip_with(xs, rotated(ys), lambda x, y: x * y)
    behind = F.zip_with(rotated(xs), ys, lambda x, y: x * y)
    terms = F.zip_with(ahead, behind, lambda a, b: a - b)
    return F.abs(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)) / 2.0


def rotation_jump_deg(before: Column, pose: Column) -> Column:
    """Angle between two row-major 4x4 poses; null without an earlier pose."""
    trace = None
    for row in range(3):
        for column in range(3):
            term = before[row * 4 + column] * pose[row * 4 + column]
            trace = term if trace is None else trace + term
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (trace - 1.0) * 0.5))
    return F.when(before.isNotNull() & pose.isNotNull(), F.degrees(F.acos(cosine)))


def translation_jump_m(before: Column, pose: Column) -> Column:
    total = None
    for row in range(3):
        step = pose[row * 4 + 3] - before[row * 4 + 3]
        total = step * step if total is None else total + step * step
    return F.when(before.isNotNull() & pose.isNotNull(), F.sqrt(total))


def center_shift_norm(cx: Column, cy: Column, px: Column, py: Column, width: Column, height: Column) -> Column:
    dx, dy = cx - px, cy - py
    return F.sqrt(dx * dx + dy * dy) / hypotenuse(width, height)


def fixed6(value: Column) -> Column:
    """Six decimals, rounded by the exact binary value (half to even).

    The formatter of the JVM rounds the shortest decimal text instead, which differs
    when the sixth decimal is followed by a lone 5.  The value is split in two halves whose
    products with 10^6 are exact, so the distance to the tie has the right sign.
    """
    x = F.abs(value)
    scaled = F.floor(x * 1e6).cast("double")
    high = x * 134217729.0 - (x * 134217729.0 - x)
    low = x - high
    beyond = (high * 1e6 - (scaled + 0.5)) + low * 1e6
    up = (beyond > 0) | ((beyond == 0) & (scaled % 2 == 1))
    units = (scaled + F.when(up, 1.0).otherwise(0.0)).cast("long")
    text = F.format_string("%d.%06d", F.floor(units / 1000000), units % 1000000)
    return F.when(value < 0, F.concat(F.lit("-"), text)).otherwise(text)


def box_label(class_id: Column, x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column) -> Column:
    """``class cx cy w h`` with six decimals, relative to the image size."""
    cx, cy = (x1 + x2) * 0.5 / width, (y1 + y2) * 0.5 / height
    w, h = (x2 - x1).cast("double") / width, (y2 - y1).cast("double") / height
    return F.concat_ws(" ", class_id.cast("string"), *[fixed6(v) for v in (cx, cy, w, h)])


def depth_to_mm(depth: Column, scale: Column) -> Column:
    """Sensor units to whole millimetres: half to even, limited to 16 bits."""
    rounded = F.bround(depth.cast("double") * scale)
    return F.least(F.greatest(rounded, F.lit(0.0)), F.lit(65535.0)).cast("int")


def depth_scale(override: Column, metadata: Column) -> Column:
    return F.coalesce(override, metadata, F.lit(0.001))


def back_project(pixel: Column, center: Column, depth: Column, focal: Column) -> Column:
    return (pixel - center) * depth / focal


def scaled_intrinsics(k: Column, scale_x: Column, scale_y: Column) -> Column:
    return F.struct(
        (k["fx"] * scale_x).alias("fx"),
        (k["fy"] * scale_y).alias("fy"),
        (k["cx"] * scale_x).alias("cx"),
        (k["cy"] * scale_y).alias("cy"),
    )


def visible_rendered(rendered_m: Column, observed_m: Column, tolerance_m: Column) -> Column:
    """A rendered pixel counts unless something measured lies in front of it."""
    no_reading = observed_m.isNull() | (observed_m <= 0)
    return (rendered_m > 0) & (no_reading | (rendered_m <= observed_m + tolerance_m))


def touches_border(x1: Column, y1: Column, x2: Column, y2: Column, width: Column, height: Column, margin: Column) -> Column:
    m = F.greatest(margin.cast("int"), F.lit(0))
    return (x1 <= m) | (y1 <= m) | (x2 >= width - m) | (y2 >= height - m)


def rate_fps(seconds_between: Column) -> Column:
    return F.lit(1.0) / F.greatest(seconds_between, F.lit(1e-6))
