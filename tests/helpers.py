"""Brute-force reference implementations for small inputs (numpy)."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

R = 6371e3


def hav(lat1, lat2, lon1, lon2):
    dlat = np.radians(lat1 - lat2) / 2
    dlon = np.radians(lon1 - lon2) / 2
    a = np.sin(dlat) ** 2 + np.sin(dlon) ** 2 * np.cos(np.radians(lat1)) * np.cos(np.radians(lat2))
    return 2 * np.arcsin(np.sqrt(a)) * R


def all_pairs(t: pd.DataFrame, radius=100.0, max_gap=28800, adjacent_slot=None) -> pd.DataFrame:
    """Every (a, b) row pair of ``t`` (columns pickup_s, dropoff_s, pickup_lon,
    pickup_lat, dropoff_lon, dropoff_lat) satisfying the return-trip rule."""
    a = t.reset_index(drop=True)
    out = []
    cols = ["pickup_s", "dropoff_s", "pickup_lon", "pickup_lat", "dropoff_lon", "dropoff_lat"]
    B = {c: a[c].to_numpy() for c in cols}
    for i in range(len(a)):
        row = a.iloc[i]
        gap = B["pickup_s"] - row.dropoff_s
        ok = gap > 0
        if adjacent_slot is None:
            ok &= gap < max_gap
        else:
            ds = B["pickup_s"] // adjacent_slot - row.dropoff_s // adjacent_slot
            ok &= (ds == 0) | (ds == 1)
        ok &= hav(B["pickup_lat"], row.dropoff_lat, B["pickup_lon"], row.dropoff_lon) <= radius
        ok &= hav(row.pickup_lat, B["dropoff_lat"], row.pickup_lon, B["dropoff_lon"]) <= radius
        for j in np.nonzero(ok)[0]:
            out.append(tuple(row[c] for c in cols) + tuple(B[c][j] for c in cols))
    names = [f"to_{c}" for c in cols] + [f"back_{c}" for c in cols]
    return pd.DataFrame(out, columns=names)


def as_bag(df) -> list[tuple]:
    """Sorted rows of a Spark or pandas DataFrame, columns sorted by name."""
    if hasattr(df, "toPandas"):
        pdf = df.toPandas()
    else:
        pdf = df
    pdf = pdf[sorted(pdf.columns)]
    rows = [tuple(float(v) if isinstance(v, float) else v for v in r) for r in pdf.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple(-math.inf if v is None else v for v in r))
