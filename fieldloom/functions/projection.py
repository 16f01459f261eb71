"""Map projection as column arithmetic: Lambert's conformal cone with two standard parallels."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldloom.operators.geo import srid_of, with_srid

#: Rounds of the inverse; each leaves under a hundredth of the error.
ROUNDS = 8


@dataclass(frozen=True)
class LambertCone:
    """Parameters in degrees and in the unit of the ellipsoid's half axis ``a``; ``f`` is its inverse flattening."""

    a: float
    f: float
    lat1: float
    lat2: float
    lat0: float
    lon0: float
    x0: float = 0.0
    y0: float = 0.0

    @property
    def e(self) -> float:
        return math.sqrt(2 / self.f - 1 / self.f**2)

    def _m(self, lat: float) -> float:
        return math.cos(lat) / math.sqrt(1 - (self.e * math.sin(lat)) ** 2)

    def _t(self, lat: float) -> float:
        s = self.e * math.sin(lat)
        return math.tan(math.pi / 4 - lat / 2) / ((1 - s) / (1 + s)) ** (self.e / 2)

    @property
    def shape(self) -> tuple[float, float, float]:
        """(n, a * F, radius of the origin's parallel)."""
        p, q, o = (math.radians(v) for v in (self.lat1, self.lat2, self.lat0))
        if p == q:
            n = math.sin(p)
        else:
            n = (math.log(self._m(p)) - math.log(self._m(q))) / (math.log(self._t(p)) - math.log(self._t(q)))
        size = self.a * self._m(p) / (n * self._t(p) ** n)
        return n, size, size * self._t(o) ** n

    def project(self, lon: Column, lat: Column) -> tuple[Column, Column]:
        """Easting and northing of degrees."""
        n, size, origin = self.shape
        phi = F.radians(lat)
        s = F.lit(self.e) * F.sin(phi)
        t = F.tan(F.lit(math.pi / 4) - phi / 2) / F.pow((1 - s) / (1 + s), F.lit(self.e / 2))
        radius = F.lit(size) * F.pow(t, F.lit(n))
        turn = F.lit(n) * F.radians(lon - self.lon0)
        return F.lit(self.x0) + radius * F.sin(turn), F.lit(self.y0 + origin) - radius * F.cos(turn)

    def unproject(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Degrees of easting and northing."""
        n, size, origin = self.shape
        sign = math.copysign(1.0, n)
        dx, dy = (x - self.x0) * sign, (F.lit(origin + self.y0) - y) * sign
        t = F.pow(F.hypot(dx, dy) / abs(size), F.lit(1 / n))
        phi = F.lit(math.pi / 2) - 2 * F.atan(t)
        for _ in range(ROUNDS):
            s = F.lit(self.e) * F.sin(phi)
            phi = F.lit(math.pi / 2) - 2 * F.atan(t * F.pow((1 - s) / (1 + s), F.lit(self.e / 2)))
        return F.degrees(F.atan2(dx, dy) / n) + self.lon0, F.degrees(phi)


# ---- fixed values ----------------------------------------------------------------
GEOGRAPHIC = 4283
#: Projected systems by SRID, all over degrees of SRID 4283 (ellipsoid GRS 80).
CONES = {3112: LambertCone(a=6378137.0, f=298.257222101, lat1=-18.0, lat2=-36.0, lat0=0.0, lon0=134.0)}
# ----------------------------------------------------------------------------------


def transform(df: DataFrame, to: int, source: int | None = None) -> DataFrame:
    """``df`` with x and y in the reference system ``to``; ``source`` is needed where x and y do not tell theirs.

    x is longitude or easting, y latitude or northing.
    """
    told = srid_of(df)
    if source is not None and told is not None and source != told:
        raise ValueError(f"x and y are of reference system {told}, not {source}")
    source = told if source is None else source
    known = {GEOGRAPHIC, *CONES}
    if source not in known or to not in known:
        raise ValueError(f"no way from reference system {source} to {to}; known are {sorted(known)}")
    x, y = F.col("x"), F.col("y")
    if source != to:
        if source in CONES:
            x, y = CONES[source].unproject(x, y)
        if to in CONES:
            x, y = CONES[to].project(x, y)
    return with_srid(df.select(*[{"x": x, "y": y}.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns]), to)
