"""Small pictures of glyphs for map packs, made on the driver: a pack has some tens of them."""

from __future__ import annotations

import struct
import zlib

import numpy as np

Ring = list[tuple[float, float]]


def coverage(rings: list[Ring], size: int, fine: int = 4, grow: float = 0.0) -> np.ndarray:
    """How much of each pixel a glyph covers, 0 to 1. rings: places in the unit square, y downwards.

    A place is in the glyph if the rings wind around it (so a ring against the others' direction is a hole). ``grow`` widens it by so many
    pixels. Each pixel is looked at in fine x fine places.
    """
    n = size * fine
    at = (np.arange(n) + 0.5) / n
    winds = np.zeros((n, n), np.int32)
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, [*ring[1:], *ring[:1]], strict=True):
            if y0 == y1:
                continue
            rows = np.nonzero((at >= min(y0, y1)) & (at < max(y0, y1)))[0]
            cross = x0 + (at[rows] - y0) * (x1 - x0) / (y1 - y0)
            winds[rows] += np.where(at[None, :] > cross[:, None], 1 if y1 > y0 else -1, 0)
    inside = winds != 0
    reach = int(round(grow * fine))
    wide = inside.copy()
    for dy in range(-reach, reach + 1):
        dx = int((reach * reach - dy * dy) ** 0.5)
        rows = np.zeros_like(inside)
        rows[max(dy, 0) : n + min(dy, 0)] = inside[max(-dy, 0) : n + min(-dy, 0)]
        sums = np.cumsum(np.pad(rows, ((0, 0), (dx + 1, dx))).astype(np.int32), axis=1)
        wide |= sums[:, 2 * dx + 1 :] > sums[:, : n]
    return wide.reshape(size, fine, size, fine).mean((1, 3))


def icon(rings: list[Ring], colour: tuple[int, int, int], size: int = 32, edge: float = 1.0, edge_colour: tuple[int, int, int] = (0, 0, 0)) -> bytes:
    """A PNG with transparency: the glyph in its colour, in front of an edge that is ``edge`` pixels wide. The same bytes for the same glyph."""
    front, back = coverage(rings, size), coverage(rings, size, grow=edge)
    alpha = front + back * (1 - front)
    mixed = front[..., None] * np.array(colour) + (back * (1 - front))[..., None] * np.array(edge_colour)
    rgb = np.divide(mixed, alpha[..., None], out=np.zeros_like(mixed), where=alpha[..., None] > 0)
    return png(np.concatenate([rgb, alpha[..., None] * 255], axis=2).round().astype(np.uint8))


def png(rgba: np.ndarray) -> bytes:
    """8-bit RGBA, lines without a filter."""
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    h, w, _ = rgba.shape
    lines = b"".join(b"\0" + line.tobytes() for line in rgba)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 6, 0, 0, 0)) + part(b"IDAT", zlib.compress(lines, 9)) + part(b"IEND", b"")
