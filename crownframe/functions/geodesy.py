"""Geographic <-> UTM coordinates (Krueger series to third order, WGS 84): of points as Column expressions, of rings as
Arrow functions, since a nested expression would be worked out again for each term of the series."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RINGS = T.ArrayType(T.ArrayType(T.DoubleType()))

# WGS 84 ellipsoid, UTM scale and false easting/northing in metres.
_A, _F = 6378137.0, 1 / 298.257223563
_K0, _E0, _N0_SOUTH = 0.9996, 500000.0, 10000000.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N ** 2 / 4 + _N ** 4 / 64)
_ALPHA = (_N / 2 - 2 * _N ** 2 / 3 + 5 * _N ** 3 / 16, 13 * _N ** 2 / 48 - 3 * _N ** 3 / 5,
          61 * _N ** 3 / 240)
_BETA = (_N / 2 - 2 * _N ** 2 / 3 + 37 * _N ** 3 / 96, _N ** 2 / 48 + _N ** 3 / 15,
         17 * _N ** 3 / 480)
_DELTA = (2 * _N - 2 * _N ** 2 / 3 - 2 * _N ** 3, 7 * _N ** 2 / 3 - 8 * _N ** 3 / 5,
          56 * _N ** 3 / 15)


def utm_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code of the UTM zone of a point: 326zz north, 327zz south."""
    zone = F.least(F.floor((lon + 180) / 6) + 1, F.lit(60))
    return (F.when(lat >= 0, F.lit(32600)).otherwise(32700) + zone).cast("int")


def _central(epsg: Column) -> Column:
    return (epsg % 100) * 6 - 183


def to_utm(lon: Column, lat: Column, epsg: Column) -> tuple[Column, Column]:
    """Easting and northing in the zone of `epsg`."""
    phi, lam = F.radians(lat), F.radians(lon - _central(epsg))
    c = 2 * math.sqrt(_N) / (1 + _N)
    sin = F.sin(phi)
    t = F.sinh(F.atanh(sin) - c * F.atanh(c * sin))
    xi = F.atan2(t, F.cos(lam))
    eta = F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    south = F.when(epsg >= 32700, F.lit(_N0_SOUTH)).otherwise(0.0)
    return _E0 + _K0 * _RADIUS * x, south + _K0 * _RADIUS * y


def from_utm(east: Column, north: Column, epsg: Column) -> tuple[Column, Column]:
    """Longitude and latitude in degrees."""
    south = F.when(epsg >= 32700, F.lit(_N0_SOUTH)).otherwise(0.0)
    xi = (north - south) / (_K0 * _RADIUS)
    eta = (east - _E0) / (_K0 * _RADIUS)
    x, y = eta, xi
    for j, b in enumerate(_BETA, 1):
        x = x - b * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y - b * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    chi = F.asin(F.sin(y) / F.cosh(x))
    phi = chi
    for j, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * j * chi)
    lam = F.atan2(F.sinh(x), F.cos(y))
    return _central(epsg) + F.degrees(lam), F.degrees(phi)


def _series(eta: np.ndarray, xi: np.ndarray, terms, sign: int) -> tuple[np.ndarray, np.ndarray]:
    x, y = eta.copy(), xi.copy()
    for j, v in enumerate(terms, 1):
        x += sign * v * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y += sign * v * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return x, y


def _to_utm(lon: np.ndarray, lat: np.ndarray, epsg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sin, lam = np.sin(np.radians(lat)), np.radians(lon - (epsg % 100 * 6 - 183))
    c = 2 * math.sqrt(_N) / (1 + _N)
    t = np.sinh(np.arctanh(sin) - c * np.arctanh(c * sin))
    x, y = _series(np.arctanh(np.sin(lam) / np.sqrt(1 + t * t)), np.arctan2(t, np.cos(lam)), _ALPHA, 1)
    return _E0 + _K0 * _RADIUS * x, np.where(epsg >= 32700, _N0_SOUTH, 0.0) + _K0 * _RADIUS * y


def _from_utm(east: np.ndarray, north: np.ndarray, epsg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    xi = (north - np.where(epsg >= 32700, _N0_SOUTH, 0.0)) / (_K0 * _RADIUS)
    x, y = _series((east - _E0) / (_K0 * _RADIUS), xi, _BETA, -1)
    chi = np.arcsin(np.sin(y) / np.cosh(x))
    phi = chi + sum(d * np.sin(2 * j * chi) for j, d in enumerate(_DELTA, 1))
    return epsg % 100 * 6 - 183 + np.degrees(np.arctan2(np.sinh(x), np.cos(y))), np.degrees(phi)


def _each_point(rings: pa.Array, epsg: pa.Array, to) -> pa.Array:
    """The rings with every point replaced by `to(x, y, epsg)`, all points of a batch at once.

    A number without its partner at the end of a ring is dropped, a ring of one number stays; a point with a null is null.
    """
    lists = rings.flatten()
    ring_row = np.asarray(pc.list_parent_indices(rings))
    numbers = lists.flatten()
    ring = np.asarray(pc.list_parent_indices(lists))
    size = np.bincount(ring, minlength=len(lists))
    place = np.arange(len(ring)) - (np.cumsum(size) - size)[ring]
    stays = (size[ring] == 1) | (place < size[ring] // 2 * 2)
    moved = size[ring[stays]] > 1
    known = np.asarray(numbers.is_valid())[stays]
    out = np.asarray(numbers.cast(pa.float64()).fill_null(np.nan))[stays].copy()
    row = ring_row[ring[stays][moved][::2]]
    zone, zoned = np.asarray(epsg.fill_null(32601)).astype(np.int64)[row], np.asarray(epsg.is_valid())[row]
    with np.errstate(all="ignore"):
        out[moved] = np.stack(to(*out[moved].reshape(-1, 2).T, zone), 1).ravel()
    both = known[moved].reshape(-1, 2).all(1) & zoned
    known[moved] = np.repeat(both, 2)
    new = np.where(size == 1, 1, size // 2 * 2)
    inner = pa.ListArray.from_arrays(_offsets(new, lists.is_valid()), pa.array(out, mask=~known))
    return pa.ListArray.from_arrays(_offsets(np.asarray(rings.value_lengths().fill_null(0)), rings.is_valid()), inner)


def _offsets(lengths: np.ndarray, valid: pa.Array) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.array(ends, mask=np.append(~np.asarray(valid), False))


@F.arrow_udf(_RINGS)
def _rings_to_utm(rings: pa.Array, epsg: pa.Array) -> pa.Array:
    return _each_point(rings, epsg, _to_utm)


@F.arrow_udf(_RINGS)
def _rings_from_utm(rings: pa.Array, epsg: pa.Array) -> pa.Array:
    return _each_point(rings, epsg, _from_utm)


def rings_to_utm(rings: Column, epsg: Column) -> Column:
    return _rings_to_utm(rings, epsg)


def rings_from_utm(rings: Column, epsg: Column) -> Column:
    return _rings_from_utm(rings, epsg)
