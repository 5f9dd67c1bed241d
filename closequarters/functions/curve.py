"""Space-filling curve over positions, as an ordinary Spark expression."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16


def _cell(col: Column, low: float, high: float) -> Column:
    """Number of the cell of ``col`` among 2**BITS equal ones; outside values
    take the first or last cell (the order may be anything there)."""
    n = F.floor((col - F.lit(low)) / F.lit(high - low) * F.lit(float(1 << BITS)))
    return F.when(n.isNotNull(), F.greatest(F.lit(0), F.least(F.lit((1 << BITS) - 1), n))).cast("long")


def _spread(x: Column) -> Column:
    """The bits of a 16-bit number at every second place of a 32-bit one."""
    for step, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, step)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def curve_key(lat: Column | str = "lat", lon: Column | str = "lon") -> Column:
    """Morton number of a position: latitude and longitude cells with their bits
    interleaved, so that near positions mostly have near numbers (null positions: null)."""
    lat, lon = (F.col(c) if isinstance(c, str) else c for c in (lat, lon))
    return F.shiftleft(_spread(_cell(lat, -90.0, 90.0)), 1).bitwiseOR(_spread(_cell(lon, -180.0, 180.0)))
