"""Colour space conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# sRGB transfer curve, sRGB -> XYZ matrix (D65 white, 2 degree observer) and
# the CIE LAB curve.
SRGB_CUT, SRGB_OFFSET, SRGB_SCALE, SRGB_GAMMA, SRGB_SLOPE = 0.04045, 0.055, 1.055, 2.4, 12.92
RGB_TO_XYZ = (
    (0.412453, 0.357580, 0.180423),
    (0.212671, 0.715160, 0.072169),
    (0.019334, 0.119193, 0.950227),
)
WHITE = (0.95047, 1.0, 1.08883)
LAB_CUT, LAB_SLOPE, LAB_OFFSET = 0.008856, 7.787, 16.0 / 116.0
# The display colour of each colour word.
WORD_RGB = {
    "red": (255, 0, 0),
    "orange": (255, 114, 0),
    "yellow": (255, 255, 0),
    "green": (0, 230, 0),
    "blue": (0, 0, 255),
    "purple": (187, 0, 187),
    "brown": (117, 60, 0),
    "pink": (255, 187, 187),
    "black": (0, 0, 0),
    "grey": (150, 150, 150),
    "white": (255, 255, 255),
}


def _inverse3(m: tuple[tuple[float, ...], ...]) -> list[list[float]]:
    (a, b, c), (d, e, f), (g, h, i) = m
    det = a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)
    return [
        [(e * i - f * h) / det, (c * h - b * i) / det, (b * f - c * e) / det],
        [(f * g - d * i) / det, (a * i - c * g) / det, (c * d - a * f) / det],
        [(d * h - e * g) / det, (b * g - a * h) / det, (a * e - b * d) / det],
    ]


XYZ_TO_RGB = _inverse3(RGB_TO_XYZ)


def _unit(channel: str, byte_input: bool) -> Column:
    value = F.col(channel).cast("double")
    return value / 255.0 if byte_input else value


def _mix(row: tuple[float, ...] | list[float], channels: list[Column]) -> Column:
    return channels[0] * row[0] + channels[1] * row[1] + channels[2] * row[2]


def rgb_to_lab(
    df: DataFrame, r: str = "R", g: str = "G", b: str = "B", byte_input: bool = True,
    keep: tuple[str, ...] = (), out: tuple[str, str, str] = ("labL", "labA", "labB"),
) -> DataFrame:
    """Keep the RGB columns and ``keep``, add CIE LAB coordinates."""

    def linear(c: Column) -> Column:
        curve = F.pow((c + SRGB_OFFSET) / SRGB_SCALE, F.lit(SRGB_GAMMA))
        return F.when(c > SRGB_CUT, curve).otherwise(c / SRGB_SLOPE)

    def response(c: Column) -> Column:
        return F.when(c > LAB_CUT, F.pow(c, F.lit(1.0 / 3.0))).otherwise(c * LAB_SLOPE + LAB_OFFSET)

    passed = list(dict.fromkeys([*keep, r, g, b]))
    lin = df.select(*passed, *[linear(_unit(c, byte_input)).alias(f"_l{i}") for i, c in enumerate((r, g, b))])
    channels = [F.col(f"_l{i}") for i in range(3)]
    xyz = lin.select(
        *passed,
        *[response(_mix(row, channels) / w).alias(f"_f{i}") for i, (row, w) in enumerate(zip(RGB_TO_XYZ, WHITE))],
    )
    fx, fy, fz = (F.col(f"_f{i}") for i in range(3))
    return xyz.select(
        *passed,
        (fy * 116.0 - 16.0).alias(out[0]),
        ((fx - fy) * 500.0).alias(out[1]),
        ((fy - fz) * 200.0).alias(out[2]),
    )


def rgb_to_hsv(
    df: DataFrame, r: str = "R", g: str = "G", b: str = "B", byte_input: bool = True,
    keep: tuple[str, ...] = (), out: tuple[str, str, str] = ("H", "S", "V"),
) -> DataFrame:
    """Keep the RGB columns and ``keep``, add hue, saturation and value in 0..1.

    Red decides the hue only when it is strictly the largest, then green when strictly
    larger than blue, else blue.
    """
    passed = list(dict.fromkeys([*keep, r, g, b]))
    units = df.select(*passed, *[_unit(c, byte_input).alias(f"_{n}") for n, c in zip("rgb", (r, g, b))])
    red, green, blue = F.col("_r"), F.col("_g"), F.col("_b")
    spread = units.withColumn("_max", F.greatest(red, green, blue)).withColumn(
        "_delta", F.col("_max") - F.least(red, green, blue)
    )
    delta = F.nullif(F.col("_delta"), F.lit(0.0))
    sector = (
        F.when((red > green) & (red > blue), (green - blue) / delta)
        .when(green > blue, (blue - red) / delta + 2.0)
        .otherwise((red - green) / delta + 4.0)
    )
    turned = spread.withColumn("_h", F.coalesce(sector / 6.0, F.lit(0.0)))
    return turned.select(
        *passed,
        F.when(F.col("_h") < 0, F.col("_h") + 1.0).otherwise(F.col("_h")).alias(out[0]),
        F.coalesce(F.col("_delta") / F.nullif(F.col("_max"), F.lit(0.0)), F.lit(0.0)).alias(out[1]),
        F.col("_max").alias(out[2]),
    )


def lab_to_rgb(
    df: DataFrame, l: str = "labL", a: str = "labA", b: str = "labB",
    keep: tuple[str, ...] = (), out: tuple[str, str, str] = ("R", "G", "B"),
) -> DataFrame:
    """CIE LAB to RGB on the 0..255 scale, out-of-gamut colours clipped."""

    def light(c: Column) -> Column:
        cut = LAB_CUT ** (1.0 / 3.0)
        return F.when(c > cut, c * c * c).otherwise((c - LAB_OFFSET) / LAB_SLOPE)

    def encode(c: Column) -> Column:
        cut = SRGB_CUT / SRGB_SLOPE
        curve = F.pow(F.greatest(c, F.lit(cut)), F.lit(1.0 / SRGB_GAMMA)) * SRGB_SCALE - SRGB_OFFSET
        encoded = F.when(c > cut, curve).otherwise(c * SRGB_SLOPE)
        return F.least(F.greatest(encoded, F.lit(0.0)), F.lit(1.0)) * 255.0

    passed = list(dict.fromkeys([*keep, l, a, b]))
    first = df.select(*passed, ((F.col(l) + 16.0) / 116.0).alias("_fy"))
    responses = first.select(
        *passed, "_fy",
        (F.col(a) / 500.0 + F.col("_fy")).alias("_fx"),
        F.greatest(F.col("_fy") - F.col(b) / 200.0, F.lit(0.0)).alias("_fz"),
    )
    xyz = responses.select(
        *passed, *[(light(F.col(f)) * w).alias(n) for f, w, n in zip(("_fx", "_fy", "_fz"), WHITE, ("_x", "_y", "_z"))]
    )
    channels = [F.col("_x"), F.col("_y"), F.col("_z")]
    return xyz.select(*passed, *[encode(_mix(row, channels)).alias(o) for row, o in zip(XYZ_TO_RGB, out)])
