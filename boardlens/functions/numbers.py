"""Texts of numbers, looked up once a worker for each pair of a coordinate and a size."""

from __future__ import annotations

import numpy as np

_texts: dict[int, dict[int, str]] = {}
TEXTS = 1 << 16


def _table(size: int) -> dict[int, str]:
    if sum(map(len, _texts.values())) > TEXTS:
        _texts.clear()
    return _texts.setdefault(size, {})


def _text(v: int, size: int, table: dict[int, str]) -> str:
    found = table.get(v)
    if found is None:
        found = table[v] = "%.6f" % (v / size)
    return found


def six_decimals(points: np.ndarray, w: int, h: int) -> str | None:
    """Flat x, y, ... as x / w and y / h with six decimals, as printf rounds the double quotients."""
    if not w or not h:
        return None
    wide, high = _table(int(w)), _table(int(h))
    flat = points.tolist()
    return " ".join([_text(v, h, high) if k & 1 else _text(v, w, wide) for k, v in enumerate(flat)])
