"""Boxes as four columns (x1, y1, x2, y2), and what two of them share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Box = tuple[Column, Column, Column, Column]


def box(prefix: str) -> Box:
    return tuple(F.col(f"{prefix}{k}") for k in ("x1", "y1", "x2", "y2"))


def area(b: Box) -> Column:
    return F.greatest(F.lit(0.0), b[2] - b[0]) * F.greatest(F.lit(0.0), b[3] - b[1])


def shared_area(a: Box, b: Box) -> Column:
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    return F.greatest(F.lit(0.0), w) * F.greatest(F.lit(0.0), h)


def iou(a: Box, b: Box) -> Column:
    """Shared area over joint area; a small constant keeps empty boxes from dividing by zero."""
    shared = shared_area(a, b)
    return shared / (area(a) + area(b) - shared + F.lit(1e-5))


def covered(inner: Box, outer: Box) -> Column:
    """Share of ``inner`` that lies in ``outer``; 0 where ``inner`` is empty."""
    own = area(inner)
    return F.when(own > 0, shared_area(inner, outer) / own).otherwise(F.lit(0.0))


def pixel_box(b: Box, width: int, height: int, of_shares: bool = True) -> Box:
    """A box in whole pixels: cut towards zero, then inside the image, the first corner at least one pixel before the edge.

    ``of_shares``: the box is given in shares of the image, not in pixels.
    """
    edge = (width, height, width, height)
    px = [((c * s) if of_shares else c).cast("int") for c, s in zip(b, edge, strict=True)]
    most = (width - 1, height - 1, width, height)
    return tuple(F.greatest(F.lit(0), F.least(p, F.lit(m))) for p, m in zip(px, most, strict=True))


def is_crop(b: Box) -> Column:
    return (b[2] > b[0]) & (b[3] > b[1])


def scaled(b: Box, width: float, height: float) -> Box:
    return b[0] * width, b[1] * height, b[2] * width, b[3] * height


def body_from_face(b: Box, width: float, height: float) -> Box:
    """The box taken for a person whose body was not found: 1.5 face widths to each side, half a height up, four down."""
    w, h = b[2] - b[0], b[3] - b[1]
    return (
        F.greatest(F.lit(0.0), b[0] - 1.5 * w),
        F.greatest(F.lit(0.0), b[1] - 0.5 * h),
        F.least(F.lit(float(width)), b[2] + 1.5 * w),
        F.least(F.lit(float(height)), b[3] + 4.0 * h),
    )


def square_crop(b: Box, width: int, height: int, grow: float = 1.5) -> Box:
    """A square around the box's centre, ``grow`` times its longer side, inside the image; whole numbers."""
    cx, cy = F.floor((b[0] + b[2]) / 2), F.floor((b[1] + b[3]) / 2)
    half = F.floor(F.floor(F.greatest(b[2] - b[0], b[3] - b[1]) * grow) / 2)
    zero = F.lit(0).cast("long")
    return (F.greatest(zero, cx - half), F.greatest(zero, cy - half), F.least(F.lit(width).cast("long"), cx + half), F.least(F.lit(height).cast("long"), cy + half))


def crop_geometry(size: Column, x: Column, y: Column, scale: float = 0.40) -> dict[str, Column]:
    """Numbers of the padded face crop: half side, padding, and the cut's bounds in the padded frame."""
    pad = F.floor(size * (1 + 2 * scale)).cast("long")
    return {
        "pad": pad,
        "top": (y + pad - size).cast("long"),
        "bottom": (y + pad + size * (1 + 2 * scale)).cast("long"),
        "left": (x + pad - size * (1 + scale)).cast("long"),
        "right": (x + pad + size * (1 + scale)).cast("long"),
    }


def text_box_area(xmin: Column, xmax: Column, ymin: Column, ymax: Column) -> Column:
    return (xmax - xmin) * (ymax - ymin)
