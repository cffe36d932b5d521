"""Scalar functions as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: WGS84 axes in metres, mean earth radius, HydroBASINS continent digits.
EARTH_A, EARTH_B = 6378137.0, 6356752.31424518
EARTH_MEAN = 6371008.8
CONTINENTS = {"1": "AF", "2": "EU", "3": "SI", "4": "AS", "5": "AU", "6": "SA", "7": "NA", "8": "AR", "9": "GR"}
_E2 = 1 - (EARTH_B / EARTH_A) ** 2
_N = (EARTH_A - EARTH_B) / (EARTH_A + EARTH_B)
UTM_SCALE, UTM_EAST, UTM_NORTH = 0.9996, 500000.0, 10000000.0
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss")
_EPOCH_MICROS = 946684800000000


def finite(c: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(F.isnan(c) | (F.abs(c) == float("inf")), None).otherwise(c)


def lon_180(lon: Column) -> Column:
    """Longitude in (-180, 180]: values over 180 go down by 360."""
    return F.when(lon > 180, lon - 360).otherwise(lon)


def lon_360(lon: Column) -> Column:
    """Longitude in [0, 360): negative values go up by 360."""
    return F.when(lon < 0, lon + 360).otherwise(lon)


def time_text(seconds: Column, style: int = 3) -> Column:
    """Seconds since 2000-01-01 as text, to the microsecond for styles 0 and 2; the session's zone must be UTC."""
    at = F.timestamp_micros(F.rint(seconds * 1e6).cast("long") + F.lit(_EPOCH_MICROS))
    return F.date_format(at, TIME_FORMATS[style])


def utm_zone(lon: Column) -> Column:
    return F.pmod(F.floor((lon + 180) / 6), F.lit(60)).cast("int") + 1


def utm_epsg(lon: Column, lat: Column) -> Column:
    """EPSG code text: 326 or 327 by hemisphere, then the zone in two digits."""
    return F.concat(F.when(lat >= 0, "326").otherwise("327"), F.lpad(utm_zone(lon).cast("string"), 2, "0"))


def _central(zone: Column) -> Column:
    return F.radians(zone * 6.0 - 183.0)


#: Krueger series to the fourth order in the third flattening.
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440, 61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280)
_BETA = (_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440, 17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280)
_DELTA = (2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45, 56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630)
_RADIUS = EARTH_A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
_ECC = math.sqrt(_E2)


def to_utm(lon: Column, lat: Column, zone: Column, north: Column) -> tuple[Column, Column]:
    """(easting, northing) in the given zone; ``north`` is whether the northern hemisphere's grid is meant."""
    phi, lam = F.radians(lat), F.radians(lon) - _central(zone)
    t = F.sinh(F.atanh(F.sin(phi)) - _ECC * F.atanh(_ECC * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for k, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
        y = y + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
    return UTM_EAST + UTM_SCALE * _RADIUS * x, F.when(north, 0.0).otherwise(UTM_NORTH) + UTM_SCALE * _RADIUS * y


def from_utm(east: Column, northing: Column, zone: Column, north: Column) -> tuple[Column, Column]:
    """(longitude, latitude) in degrees."""
    xi0 = (northing - F.when(north, 0.0).otherwise(UTM_NORTH)) / (UTM_SCALE * _RADIUS)
    eta0 = (east - UTM_EAST) / (UTM_SCALE * _RADIUS)
    xi, eta = xi0, eta0
    for k, b in enumerate(_BETA, 1):
        xi = xi - b * F.sin(2 * k * xi0) * F.cosh(2 * k * eta0)
        eta = eta - b * F.cos(2 * k * xi0) * F.sinh(2 * k * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    phi = chi
    for k, d in enumerate(_DELTA, 1):
        phi = phi + d * F.sin(2 * k * chi)
    return F.degrees(F.atan2(F.sinh(eta), F.cos(xi)) + _central(zone)), F.degrees(phi)


def surface_elevation(height: Column, geoid: Column, solid: Column, pole: Column, got: Column, fes: Column, load_tide: str = "both") -> Column:
    """Height less geoid and tides; ``load_tide`` says which load tide models are taken off: both, got or fes."""
    load = {"both": got + fes, "got": got, "fes": fes}[load_tide]
    return height - pole - load - solid - geoid


def hour_bucket(seconds: Column) -> Column:
    """Whole hours, halves to the even one."""
    return F.rint(seconds / 3600.0).cast("long")


def range_spacing(nominal: Column, incidence: Column, altitude: Column, near_range: Column, range_index: Column) -> Column:
    """Ground spacing from the incidence angle where it is positive, else from altitude over slant range."""
    cosine = F.least(altitude / (near_range + range_index * nominal), F.lit(0.99999))
    return nominal / F.sin(F.when(incidence > 0, incidence).otherwise(F.acos(cosine)))


def to_ecef(lon: Column, lat: Column, height: Column) -> tuple[Column, Column, Column]:
    phi, lam = F.radians(lat), F.radians(lon)
    n = EARTH_A / F.sqrt(1 - _E2 * F.sin(phi) ** 2)
    return (n + height) * F.cos(phi) * F.cos(lam), (n + height) * F.cos(phi) * F.sin(lam), (n * (1 - _E2) + height) * F.sin(phi)


def from_ecef(x: Column, y: Column, z: Column) -> tuple[Column, Column, Column]:
    """(longitude, latitude, height) by Bowring's closed form."""
    p = F.sqrt(x * x + y * y)
    theta = F.atan2(z * EARTH_A, p * EARTH_B)
    second = (EARTH_A / EARTH_B) ** 2 - 1
    phi = F.atan2(z + second * EARTH_B * F.sin(theta) ** 3, p - _E2 * EARTH_A * F.cos(theta) ** 3)
    n = EARTH_A / F.sqrt(1 - _E2 * F.sin(phi) ** 2)
    height = p * F.cos(phi) + z * F.sin(phi) - EARTH_A * EARTH_A / n
    return F.degrees(F.atan2(y, x)), F.degrees(phi), height


def to_enu(dx: Column, dy: Column, dz: Column, lon0: Column, lat0: Column) -> tuple[Column, Column, Column]:
    """(east, north, up) of an ECEF offset, as seen from (lon0, lat0)."""
    lam, phi = F.radians(lon0), F.radians(lat0)
    flat = F.cos(lam) * dx + F.sin(lam) * dy
    return -F.sin(lam) * dx + F.cos(lam) * dy, -F.sin(phi) * flat + F.cos(phi) * dz, F.cos(phi) * flat + F.sin(phi) * dz


def to_aer(east: Column, north: Column, up: Column) -> tuple[Column, Column, Column]:
    """(azimuth in [0, 360), elevation, range)."""
    flat = F.sqrt(east * east + north * north)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0)), F.degrees(F.atan2(up, flat)), F.sqrt(flat * flat + up * up)


def great_circle(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance in metres on the mean sphere; the cosine is clamped, and places within a billionth of a degree are 0 apart."""
    a, b = F.radians(lat1), F.radians(lat2)
    c = F.sin(a) * F.sin(b) + F.cos(a) * F.cos(b) * F.cos(F.radians(lon2 - lon1))
    same = (F.abs(lat2 - lat1) < 1e-9) & (F.abs(F.sin(F.radians(lon2 - lon1) / 2)) < 1e-11)
    return F.when(same, 0.0).otherwise(EARTH_MEAN * F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))))


def fill_out(c: Column, value) -> Column:
    """Null to a fill value, at a sink."""
    return F.coalesce(c, F.lit(value))


def fill_in(c: Column, value) -> Column:
    """A fill value to null, at a source."""
    return F.nullif(c, F.lit(value))


def refill(c: Column, old, new) -> Column:
    """One convention's fill value to another's; NaN and null count as filled."""
    return F.coalesce(F.nullif(F.nanvl(c, F.lit(None).cast("double")), F.lit(old)), F.lit(new))


def continent_of(basin: Column) -> Column:
    """Two letters for a basin code by its first digit; ``None`` as text for others."""
    table = F.create_map(*(F.lit(x) for kv in CONTINENTS.items() for x in kv))
    return F.coalesce(table[F.substring(basin, 1, 1)], F.lit("None"))


def continent_digit(name: Column) -> Column:
    table = F.create_map(*(F.lit(x) for k, v in CONTINENTS.items() for x in (v, k)))
    return F.coalesce(table[name], F.lit("None"))


def orbit_phase(cycle: Column) -> Column:
    return F.when(cycle < 400, "science").otherwise("calval")


def obs_id(basin: Column, tile: Column, side: Column, label: Column) -> Column:
    """Basin (3 digits), tile (3), swath side and the label in 6 digits."""
    return F.concat(F.substring(basin, 1, 3), F.lpad(tile.cast("string"), 3, "0"), side, F.lpad(label.cast("string"), 6, "0"))


def flatten_interferogram(re: Column, im: Column, plus: Column, minus: Column, wavelength: float) -> tuple[Column, Column]:
    """The interferogram turned back by the phase that the two antenna distances explain."""
    phase = 2 * math.pi / wavelength * (minus - plus)
    c, s = F.cos(phase), F.sin(phase)
    return re * c + im * s, im * c - re * s


def angle_between(ax: Column, ay: Column, az: Column, bx: Column, by: Column, bz: Column) -> Column:
    """Angle of two vectors in radians, exact for small ones."""
    cx, cy, cz = ay * bz - az * by, az * bx - ax * bz, ax * by - ay * bx
    return F.atan2(F.sqrt(cx * cx + cy * cy + cz * cz), ax * bx + ay * by + az * bz)


def product_name(kind: str, cycle: Column, pass_: Column, place: Column, start: Column, stop: Column, crid: Column, counter: Column, suffix: str = "") -> Column:
    """``<kind>_CCC_PPP_<place>_<start>_<stop>_<crid>_NN``; place is a tile with its side, or a continent."""
    return F.format_string(f"{kind}_%03d_%03d_%s_%s_%s_%s_%02d{suffix}", cycle.cast("int"), pass_.cast("int"), place, start, stop, crid, counter.cast("int"))


def exaggerate(height: Column, factor: float, base: float = 0.0) -> Column:
    return (height - base) * factor + base


def tile_ring(side: Column, prefix: str = "") -> Column:
    """Closed ring of a tile from its corner columns; the order turns with the swath side so that the ring runs one way."""
    corner = lambda where: F.struct(F.col(f"{prefix}{where}_longitude").alias("x"), F.col(f"{prefix}{where}_latitude").alias("y"))
    right = F.array(*map(corner, ("inner_first", "inner_last", "outer_last", "outer_first", "inner_first")))
    left = F.array(*map(corner, ("outer_first", "outer_last", "inner_last", "inner_first", "outer_first")))
    return F.when(side == "R", right).otherwise(left)


def row_line(which: str, side: Column, prefix: str = "") -> Column:
    """First or last row of a tile as a line of two points, from the lower range index on."""
    corner = lambda where: F.struct(F.col(f"{prefix}{where}_{which}_longitude").alias("x"), F.col(f"{prefix}{where}_{which}_latitude").alias("y"))
    return F.when(side == "R", F.array(corner("inner"), corner("outer"))).otherwise(F.array(corner("outer"), corner("inner")))


def node_ellipsoid_height(fit: Column, geoid: Column, load: Column, solid: Column, pole: Column) -> Column:
    """A node's fitted height above the ellipsoid."""
    return fit + geoid + load + solid + pole
