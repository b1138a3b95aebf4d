"""Column expressions shared by the operators. All of them stay inside generated code."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from veldcube.functions import fixed

A = fixed.WGS84_A
FL = fixed.WGS84_F
E2 = FL * (2 - FL)
ECC = math.sqrt(E2)
B = A * (1 - FL)


def null_invalid(value: Column, nodata: Column | float | None = None) -> Column:
    """NaN, nodata and absurdly large values become NULL; NULL stays NULL."""
    bad = F.isnan(value) | (F.abs(value) > fixed.MAX_ABS_VALUE)
    if nodata is not None:
        bad = bad | F.coalesce(value == (nodata if isinstance(nodata, Column) else F.lit(nodata)), F.lit(False))
    return F.when(~bad, value)


def normalized_difference(b8: Column, b4: Column) -> Column:
    """(b8 - b4) / (b8 + b4), NULL where the sum is zero."""
    total = b8 + b4
    return F.when(total != 0, (b8 - b4) / total)


def scale_ndvi(raw: Column) -> Column:
    return raw * F.lit(fixed.NDVI_SCALE)


def scl_visible(scl: Column, masked: list[int] | None = None) -> Column:
    return ~scl.isin(fixed.MASKED_SCL if masked is None else masked)


def month_number(year: Column, month: Column) -> Column:
    return year * 12 + month


def normal_cdf_complement_two_sided(z: Column) -> Column:
    """Two-sided normal p-value 2(1 - Phi(|z|)) = erfc(|z|/sqrt 2).

    Chebyshev fit of erfc with fractional error below 1.2e-7 (Press et al., Numerical Recipes).
    """
    x = F.abs(z) / F.lit(math.sqrt(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * x)
    # Published coefficients, highest power last.
    coefficients = [
        -1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806,
        0.27886807, -1.13520398, 1.48851587, -0.82215223, 0.17087277,
    ]
    poly = F.lit(coefficients[-1])
    for c in reversed(coefficients[:-1]):
        poly = F.lit(c) + t * poly
    return t * F.exp(-x * x + poly)


def authalic_q(lat_rad: Column) -> Column:
    """q(phi) of the WGS84 ellipsoid: band areas are (b^2/2) * dlon * dq."""
    s = F.sin(lat_rad)
    return s / (F.lit(1.0) - F.lit(E2) * s * s) + F.lit(1 / (2 * ECC)) * F.log(
        (F.lit(1.0) + F.lit(ECC) * s) / (F.lit(1.0) - F.lit(ECC) * s)
    )


def q_pole() -> float:
    return 1 / (1 - E2) + (1 / (2 * ECC)) * math.log((1 + ECC) / (1 - ECC))


def cell_area_geodesic(lat_top: Column, lat_bottom: Column, dx: Column) -> Column:
    """Area in km2 of a lon/lat cell on WGS84; it depends on the grid row only."""
    dq = authalic_q(F.radians(lat_top)) - authalic_q(F.radians(lat_bottom))
    return F.abs(F.lit(B * B / 2) * F.radians(dx) * dq) / F.lit(1e6)


def row_area(row_idx: Column, north: Column, dx: Column, dy: Column) -> Column:
    top = north + row_idx * dy
    return cell_area_geodesic(top, top + dy, dx)


def cell_area_nominal(resolution: Column) -> Column:
    return (resolution / F.lit(1000.0)) * (resolution / F.lit(1000.0))


def cell_area_approx(dx: Column, dy: Column, north: Column, n_rows: Column) -> Column:
    centre = north + dy * (n_rows / F.lit(2.0))
    k = F.lit(fixed.KM_PER_DEGREE)
    return F.abs(dx) * k * F.cos(F.radians(centre)) * F.abs(dy) * k


def edge_area_term(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Signed km2 between one edge and the equator on the authalic sphere (great-circle edges)."""
    qp = q_pole()
    radius2 = B * B / 2 * qp / 1e6

    def half_tan(lat: Column) -> Column:
        ratio = F.least(F.greatest(authalic_q(F.radians(lat)) / F.lit(qp), F.lit(-1.0)), F.lit(1.0))
        return F.tan(F.asin(ratio) / F.lit(2.0))

    t1, t2 = half_tan(lat1), half_tan(lat2)
    half_dlon = F.radians(lon2 - lon1) / F.lit(2.0)
    return F.lit(2 * radius2) * F.atan2(F.tan(half_dlon) * (t1 + t2), F.lit(1.0) + t1 * t2)


# --- transverse Mercator, Krueger series to order n^4 ------------------------------------

_N = FL / (2 - FL)
_RECT = A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ALPHA = [
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
]
_BETA = [
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
]
_DELTA = [
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
]


def lonlat_to_utm35s(lon: Column, lat: Column) -> tuple[Column, Column]:
    phi = F.radians(lat)
    dlon = F.radians(lon - F.lit(fixed.UTM_LON0))
    c = 2 * math.sqrt(_N) / (1 + _N)
    s = F.sin(phi)
    tau = F.sinh(F.atanh(s) - F.lit(c) * F.atanh(F.lit(c) * s))
    xi = F.atan2(tau, F.cos(dlon))
    eta = F.atanh(F.sin(dlon) / F.sqrt(F.lit(1.0) + tau * tau))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, start=1):
        k = F.lit(2.0 * j)
        x = x + F.lit(a) * F.cos(k * xi) * F.sinh(k * eta)
        y = y + F.lit(a) * F.sin(k * xi) * F.cosh(k * eta)
    scale = F.lit(fixed.UTM_K0 * _RECT)
    return F.lit(fixed.UTM_E0) + scale * x, F.lit(fixed.UTM_N0) + scale * y


def utm35s_to_lonlat(east: Column, north: Column) -> tuple[Column, Column]:
    scale = F.lit(fixed.UTM_K0 * _RECT)
    xi = (north - F.lit(fixed.UTM_N0)) / scale
    eta = (east - F.lit(fixed.UTM_E0)) / scale
    xi0, eta0 = xi, eta
    for j, b in enumerate(_BETA, start=1):
        k = F.lit(2.0 * j)
        xi0 = xi0 - F.lit(b) * F.sin(k * xi) * F.cosh(k * eta)
        eta0 = eta0 - F.lit(b) * F.cos(k * xi) * F.sinh(k * eta)
    chi = F.asin(F.sin(xi0) / F.cosh(eta0))
    phi = chi
    for j, d in enumerate(_DELTA, start=1):
        phi = phi + F.lit(d) * F.sin(F.lit(2.0 * j) * chi)
    lon = F.lit(fixed.UTM_LON0) + F.degrees(F.atan2(F.sinh(eta0), F.cos(xi0)))
    return lon, F.degrees(phi)
