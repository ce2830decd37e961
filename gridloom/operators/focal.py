"""Neighbourhood kernels that are too wide for a stencil: numpy over one tile with its halo, cropped to the tile."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame

from gridloom.operators.ranges import with_halo

Kernel = Callable[[np.ndarray], np.ndarray]


def tiled(cells: DataFrame, value: str, tile: int, halo: int, kernel: Kernel, out: str) -> DataFrame:
    """x, z, out for the known cells of each tile: `kernel` maps the padded grid (NaN: unknown) to a grid of the same shape.

    A group is one tile with its halo, (tile + 2 halo)^2 cells at most, however large the table is.
    """
    side = tile + 2 * halo

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x0, z0 = int(pdf["tx"].iloc[0]) * tile - halo, int(pdf["tz"].iloc[0]) * tile - halo
        grid = np.full((side, side), np.nan)
        grid[(pdf["z"] - z0).to_numpy(), (pdf["x"] - x0).to_numpy()] = pdf[value].to_numpy(float)
        found = kernel(grid)
        own = pdf[pdf["core"]]
        return pd.DataFrame({"x": own["x"], "z": own["z"], out: found[(own["z"] - z0).to_numpy(), (own["x"] - x0).to_numpy()]})

    padded = with_halo(cells.select("x", "z", value), tile, halo)
    return padded.groupBy("tx", "tz").applyInPandas(run, f"x long, z long, {out} double")


def window_median(radius: int) -> Kernel:
    """The median of the known cells of a square window."""

    def run(grid: np.ndarray) -> np.ndarray:
        padded = np.pad(grid, radius, constant_values=np.nan)
        out = np.full(grid.shape, np.nan)
        for i in range(grid.shape[0]):  # a row of windows at a time
            rows = sliding_window_view(padded[i : i + 2 * radius + 1], (2 * radius + 1, 2 * radius + 1))[0]
            known = ~np.isnan(grid[i])
            if known.any():
                out[i, known] = np.nanmedian(rows[known].reshape(int(known.sum()), -1), axis=1)
        return out

    return run


def distance_to_known(limit: int) -> Kernel:
    """Euclidean distance from each cell to the nearest one whose value is above 0, up to `limit` (NaN beyond): a separable exact transform."""

    def run(grid: np.ndarray) -> np.ndarray:
        far = float((limit + 1) ** 2)
        hit = np.nan_to_num(grid) > 0
        n, m = grid.shape
        column = np.full(hit.shape, far)
        for k in range(limit + 1):  # nearest hit in the column
            up, down = np.zeros_like(hit), np.zeros_like(hit)
            up[k:], down[: n - k] = hit[: n - k], hit[k:]
            column = np.where((up | down) & (column > k * k), float(k * k), column)
        best = column.copy()
        for k in range(1, limit + 1):  # then along rows
            for a, b in ((slice(k, None), slice(None, m - k)), (slice(None, m - k), slice(k, None))):
                best[:, a] = np.minimum(best[:, a], column[:, b] + k * k)
        return np.where(best <= limit * limit, np.sqrt(best), np.nan)

    return run


def nearest_value(limit: int) -> Kernel:
    """The value of the nearest known cell, up to `limit` (NaN beyond); of equally near ones that of least z, then least x.

    An exact feature transform: the nearest known cell of each column first, then the best column of each row of cells.
    """

    def run(grid: np.ndarray) -> np.ndarray:
        n, m = grid.shape
        z, known, far = np.arange(n)[:, None], ~np.isnan(grid), 4 * (n + m) + limit
        above = np.maximum.accumulate(np.where(known, z, -far), axis=0)
        below = np.minimum.accumulate(np.where(known, z, n + far)[::-1], axis=0)[::-1]
        own = np.where(z - above <= below - z, above, below)
        drop = (own - z) ** 2
        best, at_z, at_x = np.full((n, m), np.iinfo(np.int64).max), np.zeros((n, m), int), np.zeros((n, m), int)
        for step in range(-min(limit, m - 1), min(limit, m - 1) + 1):  # columns from the left, so the least x comes first
            here, there = (slice(max(0, -step), m - max(0, step)), slice(max(0, step), m - max(0, -step)))
            d = drop[:, there] + step * step
            wins = (d < best[:, here]) | ((d == best[:, here]) & (own[:, there] < at_z[:, here]))
            best[:, here] = np.where(wins, d, best[:, here])
            at_z[:, here] = np.where(wins, own[:, there], at_z[:, here])
            at_x[:, here] = np.where(wins, np.arange(m)[there], at_x[:, here])
        met = best <= limit * limit
        return np.where(met, grid[np.where(met, at_z, 0), np.where(met, at_x, 0)], np.nan)

    return run


def contrast(radius: int) -> Kernel:
    """The value less the median of its window."""
    median = window_median(radius)
    return lambda grid: grid - median(grid)
