"""Interrupted Goode homolosine: longitude and latitude to metres and lobes, as expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the projection.
RADIUS = 6_378_137.0
PHI_LIMIT = math.radians(40 + 44 / 60 + 11.8 / 3600)
Y_SHIFT = -0.0528035274542


def _north_centre(lon: Column) -> Column:
    return F.when(lon < -40, F.lit(-100.0)).otherwise(F.lit(30.0))


def _south_centre(lon: Column) -> Column:
    return F.when(lon < -100, F.lit(-160.0)).when(lon < -20, F.lit(-60.0)).when(lon < 80, F.lit(20.0)).otherwise(F.lit(140.0))


def to_metres(lon: Column, lat: Column, newton: int = 14) -> tuple[Column, Column]:
    """x and y in metres. Sinusoidal between the limits of latitude, Mollweide beyond, each lobe
    about its own meridian. Values that aren't finite stay null."""
    centre = F.when(lat >= 0, _north_centre(lon)).otherwise(_south_centre(lon))
    phi, lam = F.radians(lat), F.radians(lon - centre)
    # Mollweide's angle: Newton steps on t + sin t = pi sin phi, held off the poles
    goal = F.lit(math.pi) * F.sin(phi)
    step = lambda t, _: t - (t + F.sin(t) - goal) / F.greatest(F.lit(1.0) + F.cos(t), F.lit(1e-9))
    t = F.aggregate(F.sequence(F.lit(1), F.lit(newton)), F.lit(2.0) * phi, step)
    theta = F.when(F.abs(F.abs(lat) - 90) < 1e-9, phi).otherwise(t / 2)
    moll_x = F.lit(2 * math.sqrt(2) / math.pi) * lam * F.cos(theta)
    moll_y = F.lit(math.sqrt(2)) * F.sin(theta) + F.signum(phi) * Y_SHIFT
    flat = F.abs(phi) <= PHI_LIMIT
    x = F.when(flat, lam * F.cos(phi)).otherwise(moll_x) + F.radians(centre)
    y = F.when(flat, phi).otherwise(moll_y)
    ok = lon.between(-180, 180) & lat.between(-90, 90)
    return F.when(ok, x * RADIUS), F.when(ok, y * RADIUS)
