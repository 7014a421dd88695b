"""WGS84 longitude and latitude to British National Grid, as column arithmetic.

Steps: geodetic to cartesian, a seven-parameter shift between the two ellipsoids, back to geodetic,
then the Transverse Mercator series. Formulae and constants are those published by Ordnance Survey
in "A guide to coordinate systems in Great Britain". The shift is good to a few metres.
"""

import math

from pyspark.sql import functions as F

# Ellipsoid axes in metres.
WGS84_A, WGS84_B = 6378137.0, 6356752.3142
AIRY_A, AIRY_B = 6377563.396, 6356256.909

# Shift from WGS84; metres, parts per million, arc seconds.
SHIFT_X, SHIFT_Y, SHIFT_Z = -446.448, 125.157, -542.060
SCALE_PPM = 20.4894
ROTATE_X, ROTATE_Y, ROTATE_Z = -0.1502, -0.2470, -0.8421

# Projection scale on the central meridian, true origin in degrees, false origin.
F0 = 0.9996012717
ORIGIN_LAT, ORIGIN_LON = 49.0, -2.0
FALSE_EAST, FALSE_NORTH = 400000.0, -100000.0



def _number(value):
    return f"({value!r}D)"


def _constants(**values):
    return {name: _number(value) for name, value in values.items()}


_E2 = 1 - (WGS84_B / WGS84_A) ** 2
_AIRY_E2 = 1 - (AIRY_B / AIRY_A) ** 2
_N = (AIRY_A - AIRY_B) / (AIRY_A + AIRY_B)

# Each term may use those above it (lateral column aliases), so none is computed twice.
_TO_AIRY = {
    "_lam": "radians({lon})",
    "_phi": "radians({lat})",
    "_v": "{a} / sqrt(1 - {e2} * sin(_phi) * sin(_phi))",
    "_x": "_v * cos(_phi) * cos(_lam)",
    "_y": "_v * cos(_phi) * sin(_lam)",
    "_z": "_v * (1 - {e2}) * sin(_phi)",
    "_xs": "{tx} + {s} * _x - {rz} * _y + {ry} * _z",
    "_ys": "{ty} + {rz} * _x + {s} * _y - {rx} * _z",
    "_zs": "{tz} - {ry} * _x + {rx} * _y + {s} * _z",
    "_p": "sqrt(_xs * _xs + _ys * _ys)",
    # Bowring's closed form; no iteration is needed near the surface.
    "_theta": "atan2(_zs * {airy_a}, _p * {airy_b})",
    "_airy_lam": "atan2(_ys, _xs)",
    "_airy_phi": "atan2(_zs + {airy_second_e2} * {airy_b} * pow(sin(_theta), 3),"
                 " _p - {airy_e2} * {airy_a} * pow(cos(_theta), 3))",
}
_TO_AIRY_VALUES = _constants(
    a=WGS84_A, e2=_E2, tx=SHIFT_X, ty=SHIFT_Y, tz=SHIFT_Z, s=1 + SCALE_PPM * 1e-6,
    rx=math.radians(ROTATE_X / 3600), ry=math.radians(ROTATE_Y / 3600),
    rz=math.radians(ROTATE_Z / 3600), airy_a=AIRY_A, airy_b=AIRY_B, airy_e2=_AIRY_E2,
    airy_second_e2=(AIRY_A / AIRY_B) ** 2 - 1,
)

_TO_GRID = {
    "_s": "sin(_airy_phi)",
    "_c": "cos(_airy_phi)",
    "_t2": "pow(tan(_airy_phi), 2)",
    "_d": "_airy_lam - {lam0}",
    "_less": "_airy_phi - {phi0}",
    "_plus": "_airy_phi + {phi0}",
    "_w": "1 - {e2} * _s * _s",
    "_nu": "{scaled_a} / sqrt(_w)",
    "_ratio": "_nu * pow(_w, 1.5D) / ({scaled_a} * (1 - {e2}))",
    "_arc": "{scaled_b} * ({m0} * _less - {m1} * sin(_less) * cos(_plus)"
            " + {m2} * sin(2 * _less) * cos(2 * _plus)"
            " - {m3} * sin(3 * _less) * cos(3 * _plus))",
    "{x}": "{e0} + _d * _nu * _c + pow(_d, 3) * _nu / 6 * pow(_c, 3) * (_ratio - _t2)"
           " + pow(_d, 5) * _nu / 120 * pow(_c, 5)"
           " * (5 - 18 * _t2 + _t2 * _t2 + (_ratio - 1) * (14 - 58 * _t2))",
    "{y}": "{n0} + _arc + pow(_d, 2) * _nu / 2 * _s * _c"
           " + pow(_d, 4) * _nu / 24 * _s * pow(_c, 3) * (5 - _t2 + 9 * (_ratio - 1))"
           " + pow(_d, 6) * _nu / 720 * _s * pow(_c, 5) * (61 - 58 * _t2 + _t2 * _t2)",
}
_TO_GRID_VALUES = _constants(
    lam0=math.radians(ORIGIN_LON), phi0=math.radians(ORIGIN_LAT), e2=_AIRY_E2,
    scaled_a=AIRY_A * F0, scaled_b=AIRY_B * F0, e0=FALSE_EAST, n0=FALSE_NORTH,
    m0=1 + _N + 5 / 4 * _N**2 + 5 / 4 * _N**3, m1=3 * _N + 3 * _N**2 + 21 / 8 * _N**3,
    m2=15 / 8 * (_N**2 + _N**3), m3=35 / 24 * _N**3,
)


def _with_terms(df, terms, values):
    return df.selectExpr("*", *(f"{formula} AS {name}".format(**values)
                                for name, formula in terms.items()))


def transverse_mercator(df, x="osgb_x", y="osgb_y"):
    """Add easting and northing of Airy coordinates ``_airy_lam`` and ``_airy_phi`` in radians."""
    return _with_terms(df, _TO_GRID, {**_TO_GRID_VALUES, "x": x, "y": y})


def with_grid(df, lon="longitude", lat="latitude", x="osgb_x", y="osgb_y"):
    """Add easting and northing columns in metres."""
    airy = _with_terms(df, _TO_AIRY, {**_TO_AIRY_VALUES, "lon": lon, "lat": lat})
    return transverse_mercator(airy, x, y).select(*df.columns, x, y)
