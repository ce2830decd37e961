"""Crown segmentation: regions grow downhill from tree tops, in tiles with a halo."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame

from gridloom.operators.ranges import with_halo

SPAN = 1 << 24


def grow(height: np.ndarray, tops: np.ndarray, limit: float) -> np.ndarray:
    """The index of the top that each known cell belongs to, or -1: cells are taken from high to low, each by the region that reaches it first; a cell farther than `limit` from its top is dropped."""
    label = np.full(height.shape, -1)
    heap = []
    for k, (i, j) in enumerate(tops):
        label[i, j] = k
        heapq.heappush(heap, (-height[i, j], k, int(i), int(j)))
    while heap:
        _, k, i, j = heapq.heappop(heap)
        for a, b in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
            if 0 <= a < height.shape[0] and 0 <= b < height.shape[1] and label[a, b] < 0 and not np.isnan(height[a, b]):
                label[a, b] = k
                heapq.heappush(heap, (-height[a, b], k, a, b))
    if len(tops):
        i, j = np.nonzero(label >= 0)
        top = tops[label[i, j]]
        far = (i - top[:, 0]) ** 2 + (j - top[:, 1]) ** 2 > limit * limit
        label[i[far], j[far]] = -1
    return label


def local_tops(height: np.ndarray, least: float, radius: int = 2) -> np.ndarray:
    """Cells that are the highest of their window, highest first; of equal ones in a window the first in reading order stays."""
    padded = np.pad(height, radius, constant_values=np.nan)
    w = 2 * radius + 1
    best = np.nanmax(np.where(np.isnan(sliding_window_view(padded, (w, w))), -np.inf, sliding_window_view(padded, (w, w))), axis=(2, 3))
    at = np.argwhere((height == best) & (height >= least))
    at = at[np.lexsort((at[:, 1], at[:, 0], -height[at[:, 0], at[:, 1]]))]
    kept: list[tuple[int, int]] = []
    taken = np.zeros(height.shape, bool)
    for i, j in at:
        if not taken[max(0, i - radius) : i + radius + 1, max(0, j - radius) : j + radius + 1].any():
            taken[i, j] = True
            kept.append((int(i), int(j)))
    return np.array(kept, int).reshape(-1, 2)


def segment(cells: DataFrame, value: str, least: float, limit: int = 4, tile: int = 32) -> DataFrame:
    """x, z, crown (the top's x * 2^24 + z) of the cells that belong to a crown.

    A crown is at most `limit` cells wide around its top and tops come from 5 x 5 windows, so a halo of 3 * limit + 2 holds
    every top that competes for a tile's cells; labels are places, so tiles join without relabelling. Cells below `least`
    are no canopy.
    """
    halo = 3 * limit + 2
    side = tile + 2 * halo

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x0, z0 = int(pdf["tx"].iloc[0]) * tile - halo, int(pdf["tz"].iloc[0]) * tile - halo
        grid = np.full((side, side), np.nan)
        grid[(pdf["z"] - z0).to_numpy(), (pdf["x"] - x0).to_numpy()] = pdf[value].to_numpy(float)
        grid[grid < least] = np.nan
        tops = local_tops(grid, least)
        label = grow(grid, tops, limit)
        own = pdf[pdf["core"]]
        k = label[(own["z"] - z0).to_numpy(), (own["x"] - x0).to_numpy()]
        own, k = own[k >= 0], k[k >= 0]
        return pd.DataFrame({"x": own["x"], "z": own["z"], "crown": (tops[k, 1] + x0) * SPAN + tops[k, 0] + z0 if len(k) else pd.Series(dtype="int64")})

    padded = with_halo(cells.select("x", "z", value), tile, min(halo, tile))
    return padded.groupBy("tx", "tz").applyInPandas(run, "x long, z long, crown long")
