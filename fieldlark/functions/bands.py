"""Band arithmetic as column expressions; a zero denominator gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers, scales and ranges of byte images.
NODATA, HIGHEST = 255, 250
#: Scale and offset of packed bytes, by index.
PACKING = {"ndvi": (0.004, -0.08), "bsi": (0.004, -0.08), "dprvi": (0.004, 0.0), "rvi": (0.004, 0.0)}
#: dB ranges of the red, green and blue channel, for raw and despeckled images.
SAR_RANGES = {False: ((-22.0, -5.0), (-23.0, -12.0), (2.0, 13.0)), True: ((-21.0, -5.0), (-23.0, -12.0), (3.0, 12.0))}


def ndvi(red: Column, nir: Column) -> Column:
    return F.try_divide(nir - red, nir + red)


def bsi(blue: Column, red: Column, nir: Column, swir: Column) -> Column:
    bare, green = swir + red, nir + blue
    return F.try_divide(bare - green, bare + green)


def dprvi(vv: Column, vh: Column) -> Column:
    q = F.try_divide(vh, vv)
    return F.try_divide(q * (q + 3), (q + 1) * (q + 1))


def rvi(vv: Column, vh: Column) -> Column:
    return F.try_divide(4 * vh, vv + vh)


def ratio(vv: Column, vh: Column) -> Column:
    return F.try_divide(vv, vh)


def decibel(x: Column) -> Column:
    return F.when(x > 0, 10 * F.log10(x))


def sar_rgb(vv: Column, vh: Column, in_db: bool = True) -> tuple[Column, Column, Column]:
    """Red VV, green VH, blue their ratio; in dB the ratio is the difference."""
    if not in_db:
        return vv, vh, ratio(vv, vh)
    a, b = decibel(vv), decibel(vh)
    return a, b, a - b


def sar_rgb_bytes(vv: Column, vh: Column, despeckled: bool = False) -> tuple[Column, ...]:
    """The dB channels stretched over 0..254, NODATA where there is no value."""
    out = []
    for x, (low, high) in zip(sar_rgb(vv, vh), SAR_RANGES[despeckled], strict=True):
        y = F.least(F.greatest((x - low) / (high - low) * 254, F.lit(0.0)), F.lit(254.0))
        out.append(F.when(x.isNull(), NODATA).otherwise(y.cast("int")).cast("short"))
    return tuple(out)


def pack(x: Column, index: str) -> Column:
    """Bytes of a scaled index: HIGHEST at most, 0 at least, NODATA for null; fractions are cut off."""
    scale, offset = PACKING[index]
    y = F.least((x - offset) / scale, F.lit(float(HIGHEST)))
    return F.greatest(F.when(x.isNull(), float(NODATA)).otherwise(y), F.lit(0.0)).cast("int").cast("short")


def unpack(x: Column, index: str = "ndvi") -> Column:
    """Values of packed bytes, null for NODATA."""
    scale, offset = PACKING[index]
    return F.when(x != NODATA, x * scale + offset)


def date_score(d: Column) -> Column:
    """Highest in the middle of the month."""
    return F.exp(-0.5 * F.pow((F.dayofmonth(d) - 15) * 0.2, 2.0)) * 0.07978845
