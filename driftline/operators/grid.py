"""Area means of gridded values and the weights of cells in an outline."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftline.session import written


def area_mean(rows: DataFrame, weights: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted mean over the cells with a value and the share of weight they hold; a day without any is kept, null."""
    w = F.col("weight")
    has = F.when(F.col("value").isNotNull(), w)
    return rows.join(weights, ["latitude", "longitude"]).groupBy(*keys).agg(
        F.try_divide(F.sum(F.col("value") * w), F.sum(has)).alias("value"), (F.coalesce(F.sum(has), F.lit(0.0)) / F.sum(w)).alias("covered")
    )


# --- projection and clip -------------------------------------------------------------------------

#: Half axis and flattening of WGS 84, scale and false easting of UTM.
A_AXIS, FLATTENING, SCALE, EASTING = 6378137.0, 1 / 298.257223563, 0.9996, 500_000.0


def utm_zone(lon: float) -> int:
    return int(np.floor((lon + 180) / 6)) % 60 + 1


def utm(lon: np.ndarray, lat: np.ndarray, zone: int) -> np.ndarray:
    """Easting and northing in metres by Krueger's series to the fourth order of the third flattening.

    Northings south of the equator are negative, as areas need no false northing.
    """
    n = FLATTENING / (2 - FLATTENING)
    series = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180, 13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440, 61 * n**3 / 240 - 103 * n**4 / 140, 49561 * n**4 / 161280)
    radius = A_AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    phi, lam = np.radians(lat), np.radians((np.asarray(lon) - (6 * zone - 183) + 180) % 360 - 180)
    e = 2 * np.sqrt(n) / (1 + n)
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    east = eta + sum(a * np.cos(2 * j * xi) * np.sinh(2 * j * eta) for j, a in enumerate(series, 1))
    north = xi + sum(a * np.sin(2 * j * xi) * np.cosh(2 * j * eta) for j, a in enumerate(series, 1))
    return np.stack([EASTING + SCALE * radius * east, SCALE * radius * north], axis=-1)


def _area(points: np.ndarray) -> float:
    x, y = (points - points[0]).T
    return float((x * np.roll(y, -1) - y * np.roll(x, -1)).sum() / 2)


def clip_area(ring: np.ndarray, box: np.ndarray) -> float:
    """Area of a ring inside a convex box: the ring is cut at each side in turn, then measured by its corners."""
    box = box if _area(box) > 0 else box[::-1]
    points = ring
    for p, q in zip(box, np.roll(box, -1, 0), strict=True):
        if len(points) < 3:
            return 0.0
        nxt = np.roll(points, -1, 0)
        side = lambda r: (q[0] - p[0]) * (r[:, 1] - p[1]) - (q[1] - p[1]) * (r[:, 0] - p[0])  # noqa: B023, E731
        out = []
        for r, s, u, v in zip(points, nxt, side(points), side(nxt), strict=True):
            if u >= 0:
                out.append(r)
            if (u >= 0) != (v >= 0):
                out.append(r + (s - r) * (u / (u - v)))
        points = np.array(out).reshape(-1, 2)
    return abs(_area(points)) if len(points) > 2 else 0.0


def cell_weights(cells: DataFrame, outline: list, step: float = 0.01) -> DataFrame:
    """Area in square metres of each distinct cell inside an outline; an outline that meets no cell is refused.

    ``outline`` is a ring of (lon, lat) corners, or a list of polygons, each of an outer ring
    and rings of holes. Outline and cells are projected to the UTM zone of the outline's
    middle and clipped there. Cells beyond the outline's box are filtered
    before, and slivers below a thousandth of a square metre, which rounding makes, do not count.
    """
    polygons = [[outline]] if np.ndim(outline[0][0]) == 0 else outline
    corners = np.concatenate([np.array(p[0], float) for p in polygons])
    zone = utm_zone(float((corners[:, 0].min() + corners[:, 0].max()) / 2))
    plane = [[utm(*np.array(ring, float).T, zone) for ring in p] for p in polygons]
    half = step / 2
    lo, hi = corners.min(0) - half, corners.max(0) + half
    around = np.array([(-half, -half), (half, -half), (half, half), (-half, half)])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            areas = []
            for lat, lon in zip(f["latitude"], f["longitude"], strict=True):
                box = utm(lon + around[:, 0], lat + around[:, 1], zone)
                areas.append(sum(clip_area(p[0], box) - sum(clip_area(hole, box) for hole in p[1:]) for p in plane))
            yield f.assign(weight=areas)

    near = cells.select("latitude", "longitude").distinct().filter(
        F.col("longitude").between(float(lo[0]), float(hi[0])) & F.col("latitude").between(float(lo[1]), float(hi[1]))
    )
    weights = written(near.mapInPandas(run, "latitude double, longitude double, weight double").filter("weight > 1e-3"), "weights")
    if weights.isEmpty():
        raise ValueError("the outline meets no cell of the grid")
    return weights
