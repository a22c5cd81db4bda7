"""Well-known binary: points, polygons and multipolygons, and the point-in-polygon test."""

from __future__ import annotations

import struct
from functools import lru_cache

import numpy as np

OUT, BOUNDARY, IN = 0, 1, 2


def point_wkb(lon: float, lat: float) -> bytes:
    return struct.pack("<BIdd", 1, 1, lon, lat)


def polygon_wkb(rings: list[list[tuple[float, float]]]) -> bytes:
    out = struct.pack("<BII", 1, 3, len(rings))
    for ring in rings:
        out += struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", x, y) for x, y in ring)
    return out


def multipolygon_wkb(polygons: list[list[list[tuple[float, float]]]]) -> bytes:
    return struct.pack("<BII", 1, 6, len(polygons)) + b"".join(polygon_wkb(p) for p in polygons)


@lru_cache(maxsize=4096)
def parse_parts(data: bytes) -> tuple[tuple[np.ndarray, ...], ...]:
    """Parts of a polygon or multipolygon, each a tuple of rings of shape (n, 2).

    Either byte order.  Anything else (a point, a truncated or empty value)
    raises ValueError.
    """
    parts: list[tuple[np.ndarray, ...]] = []

    def read(at: int) -> int:
        if len(data) < at + 9:
            raise ValueError("truncated geometry")
        order = "<" if data[at] == 1 else ">"
        kind = struct.unpack_from(order + "I", data, at + 1)[0] & 0xFF
        count = struct.unpack_from(order + "I", data, at + 5)[0]
        at += 9
        if kind == 3:
            rings = []
            for _ in range(count):
                n = struct.unpack_from(order + "I", data, at)[0]
                ring = np.frombuffer(data, order + "f8", 2 * n, at + 4).reshape(n, 2).astype("f8")
                rings.append(ring)
                at += 4 + 16 * n
            parts.append(tuple(rings))
        elif kind == 6:
            for _ in range(count):
                at = read(at)
        else:
            raise ValueError(f"geometry type {kind} is no polygon")
        return at

    try:
        read(0)
    except struct.error as e:
        raise ValueError("truncated geometry") from e
    return tuple(p for p in parts if p and len(p[0]))


def side_of(rings: tuple[np.ndarray, ...], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """OUT, BOUNDARY or IN of each point against one part (even-odd over all its rings)."""
    inside = np.zeros(len(x), dtype=bool)
    edge = np.zeros(len(x), dtype=bool)
    px, py = x[:, None], y[:, None]
    for ring in rings:
        ax, ay = ring[:, 0], ring[:, 1]
        bx, by = np.roll(ax, -1), np.roll(ay, -1)
        cross = (bx - ax) * (py - ay) - (by - ay) * (px - ax)
        within = (
            (px >= np.minimum(ax, bx)) & (px <= np.maximum(ax, bx)) & (py >= np.minimum(ay, by)) & (py <= np.maximum(ay, by))
        )
        edge |= ((cross == 0) & within).any(axis=1)
        spans = (ay > py) != (by > py)
        left = np.where(by > ay, cross > 0, cross < 0)
        inside ^= (spans & left).sum(axis=1) % 2 == 1
    return np.where(edge, BOUNDARY, np.where(inside, IN, OUT)).astype("i1")
