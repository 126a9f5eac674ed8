"""Fire-alert colour from temperature, humidity, CO2 and CO."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they must equal the original rule).  Bands per colour, as
# (low, high) with the side that includes the edge named per measure:
#   temperature T: low <= T < high      humidity H: low < H <= high
#   CO2:           low <= CO2 < high    CO:         low <= CO < high
# None = unbounded.
#   Green  T < 30, H > 30, CO2 < 350, CO < 10 (all four)
#   Yellow T 30..37, H 20..30, CO2 350..2000, CO 10..25
#   Orange T 37..40, H 10..20, CO2 2000..5000, CO 25..50
#   Red    T >= 40, H <= 10, CO2 >= 5000, CO >= 50
BANDS = {
    "Green": ((None, 30), (30, None), (None, 350), (None, 10)),
    "Yellow": ((30, 37), (20, 30), (350, 2000), (10, 25)),
    "Orange": ((37, 40), (10, 20), (2000, 5000), (25, 50)),
    "Red": ((40, None), (None, 10), (5000, None), (50, None)),
}


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def _in_band(v: Column, band, humidity: bool) -> Column:
    low, high = band
    cond = F.lit(True)
    if low is not None:
        cond = cond & ((v > low) if humidity else (v >= low))
    if high is not None:
        cond = cond & ((v <= high) if humidity else (v < high))
    return cond


def fire_alert(temp="temp", humd="humd", co2="CO2", co="CO", strict: bool = False) -> Column:
    """Ordered rule, first hit wins, '' when none hits.

    Green needs all four measures in its band.  Default (the live rule):
    Yellow and Orange are hit by ANY one measure in the band; Red by
    (T and H both in band) OR (CO2 and CO both in band).  ``strict=True`` is
    the other rule: Yellow, Orange and Red need all four measures in band.
    """
    measures = (_c(temp), _c(humd), _c(co2), _c(co))

    def hits(colour):
        return [_in_band(v, b, i == 1) for i, (v, b) in enumerate(zip(measures, BANDS[colour]))]

    def all_of(cs):
        return cs[0] & cs[1] & cs[2] & cs[3]

    def any_of(cs):
        return cs[0] | cs[1] | cs[2] | cs[3]

    green = all_of(hits("Green"))
    if strict:
        yellow, orange, red = all_of(hits("Yellow")), all_of(hits("Orange")), all_of(hits("Red"))
    else:
        r = hits("Red")
        yellow, orange = any_of(hits("Yellow")), any_of(hits("Orange"))
        red = (r[0] & r[1]) | (r[2] & r[3])
    return (F.when(green, "Green").when(yellow, "Yellow").when(orange, "Orange")
            .when(red, "Red").otherwise(""))
