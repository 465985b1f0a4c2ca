"""Order-insensitive comparison of two result frames (pandas)."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pandas as pd


def norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, (float, np.floating)):
        f = float(v)
        if math.isnan(f):
            return None
        return int(f) if f.is_integer() and abs(f) < 2**53 else f
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        t = pd.Timestamp(v)
        if t.tzinfo is not None:
            t = t.tz_convert("UTC").tz_localize(None)
        return t.isoformat()
    if isinstance(v, np.integer):
        return int(v)
    if isinstance(v, np.bool_):
        return bool(v)
    return v


def rows(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    out = [tuple(norm(x) for x in rec) for rec in pdf[cols].itertuples(index=False, name=None)]
    out.sort(key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))
    return cols, out


def same(a: pd.DataFrame, b: pd.DataFrame) -> tuple[bool, str]:
    ac, ar = rows(a)
    bc, br = rows(b)
    if ac != bc:
        return False, f"columns differ: {ac} vs {bc}"
    if len(ar) != len(br):
        return False, f"row counts differ: {len(ar)} vs {len(br)}"
    if ar != br:
        sa, sb = set(ar), set(br)
        return False, f"values differ, e.g. {[r for r in ar if r not in sb][:2]} vs {[r for r in br if r not in sa][:2]}"
    return True, ""
