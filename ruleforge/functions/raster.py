"""Sheets of figures as NumPy rasters and PNG files, without an imaging library."""

from __future__ import annotations

import struct
import zlib

import numpy as np

from .images import resized

# Bands of a sheet in pixels, its width, letters as 5 x 7 dots.
TOP, ROW_GAP, QUESTION_BAND, LABEL_BAND, WIDTH4, WIDTH10 = 50, 70, 70, 85, 800, 1000
GLYPHS = {
    "A": "0e1111" "1f111111", "B": "1e1111" "1e11111e", "C": "0e1110" "1010110e", "D": "1e1111" "1111111e", "E": "1f1010" "1e10101f", "F": "1f1010" "1e101010",
    "G": "0e1110" "1711110f", "H": "111111" "1f111111", "I": "0e0404" "0404040e", "J": "070202" "0202120c", "?": "0e1101" "02040004",
}


def rgb(pixels: np.ndarray) -> np.ndarray:
    """(h, w, 3) bytes of a gray, RGB or RGBA raster; transparency over white."""
    x = np.asarray(pixels)
    if x.ndim == 2:
        return np.repeat(x[..., None], 3, axis=2).astype(np.uint8)
    if x.shape[2] == 4:
        a = x[..., 3:].astype(float) / 255
        return np.rint(x[..., :3] * a + 255 * (1 - a)).astype(np.uint8)
    return x.astype(np.uint8)


def png(pixels: np.ndarray) -> bytes:
    x = rgb(pixels)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    body = np.concatenate((np.zeros((x.shape[0], 1), np.uint8), x.reshape(x.shape[0], -1)), axis=1).tobytes()
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", x.shape[1], x.shape[0], 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")


def scaled(pixels: np.ndarray, h: int, w: int) -> np.ndarray:
    x = rgb(pixels).astype(float)
    return np.rint(np.stack([resized(x[..., c], h, w) for c in range(3)], axis=2)).clip(0, 255).astype(np.uint8)


def pasted(canvas: np.ndarray, pixels: np.ndarray, top: int, left: int, h: int, w: int) -> None:
    """Draws an image into a box of the canvas, as large as fits with its sides in proportion, in the middle."""
    ih, iw = pixels.shape[:2]
    s = min(w / iw, h / ih)
    nh, nw = max(1, int(ih * s)), max(1, int(iw * s))
    y, x = top + (h - nh) // 2, left + (w - nw) // 2
    canvas[y : y + nh, x : x + nw] = scaled(pixels, nh, nw)


def lettered(canvas: np.ndarray, letter: str, top: int, left: int, dot: int = 4) -> None:
    bits = np.array([[int(GLYPHS[letter][2 * r : 2 * r + 2], 16) >> (4 - c) & 1 for c in range(5)] for r in range(7)], bool)
    big = np.kron(bits, np.ones((dot, dot), bool))
    canvas[top : top + 7 * dot, left : left + 5 * dot][big] = 0


def sheet(question: list[np.ndarray], options: list[np.ndarray], cell: int = 150, margin: int = 20, width: int | None = None) -> np.ndarray:
    """The question's figures and a question mark in a row, the options under them in rows of five with their letters."""
    rows = -(-len(options) // 5)
    h = TOP + cell + ROW_GAP + QUESTION_BAND + rows * (cell + LABEL_BAND) + margin
    canvas = np.full((h, 5 * cell + 2 * margin, 3), 255, np.uint8)
    for i, x in enumerate(question[:4]):
        pasted(canvas, x, TOP, margin + i * cell, cell, cell)
    lettered(canvas, "?", TOP + cell // 2 - 28, margin + 4 * cell + cell // 2 - 20, 8)
    for i, x in enumerate(options):
        top, left = TOP + cell + ROW_GAP + QUESTION_BAND + i // 5 * (cell + LABEL_BAND), margin + i % 5 * cell
        pasted(canvas, x, top, left, cell, cell)
        lettered(canvas, "ABCDEFGHIJ"[i], top + cell + 20, left + cell // 2 - 10)
    width = width or (WIDTH4 if len(options) <= 4 else WIDTH10)
    return scaled(canvas, max(1, h * width // canvas.shape[1]), width)
