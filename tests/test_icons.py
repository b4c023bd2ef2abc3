import struct
import zlib

import numpy as np

from terrasift.sinks.icons import coverage, icon

SQUARE = [(0.25, 0.25), (0.75, 0.25), (0.75, 0.75), (0.25, 0.75)]


def brute(rings, size, fine, grow):
    """Each place by angles around it, and by its distance to places inside."""
    n = size * fine
    inside = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            z = (j + 0.5) / n + 1j * (i + 0.5) / n
            turns = sum(np.angle((complex(*b) - z) / (complex(*a) - z)) for r in rings for a, b in zip(r, r[1:] + r[:1], strict=True))
            inside[i, j] = abs(turns) > 1
    ys, xs = np.nonzero(inside)
    reach = round(grow * fine)
    out = np.array([[len(ys) > 0 and ((ys - i) ** 2 + (xs - j) ** 2).min() <= reach * reach for j in range(n)] for i in range(n)])
    return out.reshape(size, fine, size, fine).mean((1, 3))


def test_coverage_against_brute_force():
    hole = [(0.4, 0.4), (0.4, 0.6), (0.6, 0.6), (0.6, 0.4)]
    star = [(0.5, 0.03), (0.8, 0.95), (0.02, 0.4), (0.97, 0.41), (0.2, 0.96)]
    for rings in ([SQUARE], [SQUARE, hole], [SQUARE, hole[::-1]], [star], [SQUARE, [(x + 0.2, y + 0.1) for x, y in SQUARE]], []):
        for grow in (0.0, 1.0):
            assert np.array_equal(coverage(rings, 9, 3, grow), brute(rings, 9, 3, grow))


def test_icon():
    data = icon([SQUARE], (200, 10, 20), size=16)
    assert data == icon([SQUARE], (200, 10, 20), size=16) and struct.unpack(">II", data[16:24]) == (16, 16)
    at = data.index(b"IDAT")
    raw = np.frombuffer(zlib.decompress(data[at + 4 : at + 4 + struct.unpack(">I", data[at - 4 : at])[0]]), np.uint8).reshape(16, 65)[:, 1:].reshape(16, 16, 4)
    assert raw[8, 8].tolist() == [200, 10, 20, 255] and raw[3, 8, :3].tolist() == [0, 0, 0] and raw[3, 8, 3] > 200 and raw[0, 0, 3] == 0
