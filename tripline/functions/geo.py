"""Distances and map projection as column expressions."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# They define the distance estimate.
EARTH_RADIUS_MILES = 3958.8
ROUTING_FACTOR = 1.35


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in miles between two points in degrees."""
    sin_lat = F.sin(F.radians(lat2 - lat1) / 2)
    sin_lon = F.sin(F.radians(lon2 - lon1) / 2)
    a = sin_lat * sin_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * sin_lon * sin_lon
    return F.atan2(F.sqrt(a), F.sqrt(1 - a)) * (2 * EARTH_RADIUS_MILES)


def routed_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column,
                 factor: float = ROUTING_FACTOR) -> Column:
    """Street-distance estimate: great circle times a routing factor, 2 dp."""
    return F.round(haversine_miles(lat1, lon1, lat2, lon2) * F.lit(factor), 2)


@dataclass(frozen=True)
class LambertConic:
    """A Lambert conformal conic system with two standard parallels, or one given twice.

    Angles are in degrees, lengths in the system's own unit. An inverse
    flattening of 0 is a sphere.
    """

    semi_major_m: float
    inverse_flattening: float
    unit_m: float
    false_easting: float
    false_northing: float
    central_meridian: float
    parallel_1: float
    parallel_2: float
    origin_latitude: float
    scale_factor: float = 1.0

    @property
    def eccentricity(self) -> float:
        f = 1.0 / self.inverse_flattening if self.inverse_flattening else 0.0
        return math.sqrt(2.0 * f - f * f)

    def _m(self, degrees: float) -> float:
        s = math.sin(math.radians(degrees))
        return math.cos(math.radians(degrees)) / math.sqrt(1.0 - (self.eccentricity * s) ** 2)

    def t(self, degrees: float) -> float:
        """Snyder's t: the tangent of half the conformal co-latitude."""
        e, phi = self.eccentricity, math.radians(degrees)
        return math.tan(math.pi / 4 - phi / 2) * math.exp(e * math.atanh(e * math.sin(phi)))

    @property
    def cone(self) -> float:
        """n, the cone constant."""
        if self.parallel_1 == self.parallel_2:
            return math.sin(math.radians(self.parallel_1))
        return (math.log(self._m(self.parallel_1) / self._m(self.parallel_2))
                / math.log(self.t(self.parallel_1) / self.t(self.parallel_2)))

    @property
    def scale(self) -> float:
        """a*F, in the system's unit."""
        n = self.cone
        return (self.scale_factor * self.semi_major_m / self.unit_m
                * self._m(self.parallel_1) / (n * self.t(self.parallel_1) ** n))

    @property
    def origin_radius(self) -> float:
        """rho at the latitude of origin."""
        return self.scale * self.t(self.origin_latitude) ** self.cone


# The zone polygons' system (NAD83, New York Long Island, US feet).
NY_LONG_ISLAND_FEET = LambertConic(
    semi_major_m=6378137.0,
    inverse_flattening=298.257222101,
    unit_m=0.304800609601219,
    false_easting=984250.0,
    false_northing=0.0,
    central_meridian=-74.0,
    parallel_1=41.0333333333333,
    parallel_2=40.6666666666667,
    origin_latitude=40.1666666666667,
)


def conic_to_lonlat(x: Column, y: Column,
                    system: LambertConic = NY_LONG_ISLAND_FEET,
                    steps: int = 6) -> tuple[Column, Column]:
    """Inverse Lambert conformal conic (Snyder, USGS PP 1395): (lon, lat) degrees.

    Latitude has no closed form on the ellipsoid; the fixed point is unrolled.
    Writing the ellipsoid term as exp(e*atanh(e*sin(phi))) uses the previous
    latitude once per step, so the expression grows linearly, not as 2^steps.
    """
    e, n = system.eccentricity, system.cone
    east = x - F.lit(system.false_easting)
    north = F.lit(system.origin_radius) - (y - F.lit(system.false_northing))
    rho = F.sqrt(east * east + north * north)
    t = F.pow(rho / F.lit(system.scale), F.lit(1.0 / n))
    half_pi = F.lit(math.pi / 2)
    lat = half_pi - F.atan(t) * 2
    for _ in range(steps):
        lat = half_pi - F.atan(t * F.exp(F.atanh(F.sin(lat) * e) * -e)) * 2
    lon = F.atan2(east, north) / F.lit(n)
    return F.degrees(lon) + F.lit(system.central_meridian), F.degrees(lat)
