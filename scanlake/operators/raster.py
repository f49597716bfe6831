"""What pixel filters share: fixed values, gray values and the angle of an ink distribution as columns.

The filters themselves work on tiles (``scanlake.operators.tiles``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE_KEY = ["image_id", "page_number"]

# Weights are summed as integers so that sums do not depend on row order.
WEIGHT_ONE = 1 << 22

# Local threshold window, its two constants, fill colour.
SAUVOLA_WINDOW = 25
SAUVOLA_K = 0.2
SAUVOLA_R = 127.5
WHITE = 255
FEWEST_INK_PIXELS = 5


def luma(red: Column, green: Column, blue: Column) -> Column:
    """Gray value of an RGB pixel, rounded as integers (ITU-R 601 weights, 16 bits)."""
    # 0.299, 0.587 and 0.114 times 65536.
    weighted = red * 19595 + green * 38470 + blue * 7471 + 32768
    return F.shiftright(weighted.cast("int"), 16)


def angle_of_sums() -> Column:
    """Angle of the principal axis in degrees, folded to -45..45, from n, sy, sx, syy, sxx and sxy."""
    n, sy, sx, syy, sxx, sxy = (
        F.col(c).cast("decimal(19,0)") for c in ("n", "sy", "sx", "syy", "sxx", "sxy")
    )
    covariance = (n * sxy - sx * sy).cast("double")
    spread = ((n * sxx - sx * sx) - (n * syy - sy * sy)).cast("double")
    angle = F.degrees(F.lit(0.5) * F.atan2(F.lit(2.0) * covariance, spread))
    return F.when(angle > 45, angle - 90).when(angle < -45, angle + 90).otherwise(angle)
