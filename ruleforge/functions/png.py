"""PNG files to NumPy arrays and back: all colour types, bit depths, filters and interlacing, without an imaging library."""

from __future__ import annotations

import struct
import zlib

import numpy as np

# Fixed values of the format: its signature, samples a pixel and bit depths by colour type, the passes of interlaced images (first row, first column, row step, column step).
SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
DEPTHS = {0: (1, 2, 4, 8, 16), 2: (8, 16), 3: (1, 2, 4, 8), 4: (8, 16), 6: (8, 16)}
PASSES = ((0, 0, 8, 8), (0, 4, 8, 8), (4, 0, 8, 4), (0, 2, 4, 4), (2, 0, 4, 2), (0, 1, 2, 2), (1, 0, 2, 1))
#: Pixels of an image beyond which it counts as unreadable, so that a small file can't fill a worker.
MOST_PIXELS = 1 << 26


class Unreadable(ValueError):
    pass


def _chunks(data: bytes):
    if data[:8] != SIGNATURE:
        raise Unreadable("no PNG file")
    at = 8
    while at + 12 <= len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if len(body) < size or data[at + 8 + size : at + 12 + size] != struct.pack(">I", zlib.crc32(kind + body)):
            raise Unreadable("broken chunk")
        yield kind, body
        if kind == b"IEND":
            return
        at += 12 + size
    raise Unreadable("cut short")


def unfiltered(rows: np.ndarray, kinds: np.ndarray, step: int) -> np.ndarray:
    """Scan lines (h, width in bytes) with their filters taken off; ``step`` is the bytes of a pixel.

    A byte needs those to its left, above and above left, so all bytes on one diagonal of pixels are done at once, each row by its own filter.
    """
    h, width = rows.shape
    if kinds.max(initial=0) > 4:
        raise Unreadable("unknown filter")
    n = -(-width // step)
    out = np.zeros((h + 1, (n + 1) * step), np.uint8)  # a row of zeros above, a pixel of zeros on the left
    source = np.zeros((h, n * step), np.uint8)
    source[:, :width] = rows
    pixel, raw = out.reshape(h + 1, n + 1, step), source.reshape(h, n, step)
    if not kinds.any():
        return rows
    for d in range(h + n - 1):
        r = np.arange(max(0, d - n + 1), min(h, d + 1))
        c = d - r
        left, up, corner = (pixel[a, b].astype(np.int16) for a, b in ((r + 1, c), (r, c + 1), (r, c)))
        guess = left + up - corner
        a, b, e = np.abs(guess - left), np.abs(guess - up), np.abs(guess - corner)
        paeth = np.where((a <= b) & (a <= e), left, np.where(b <= e, up, corner))
        kind = kinds[r][:, None]
        add = np.select([kind == 1, kind == 2, kind == 3, kind == 4], [left, up, (left + up) >> 1, paeth], 0)
        pixel[r + 1, c + 1] = (raw[r, c] + add).astype(np.uint8)
    return out[1:, step : step + width]


def _samples(data: bytes, at: int, h: int, w: int, depth: int, channels: int) -> tuple[np.ndarray, int]:
    """((h, w, channels) samples, where the next pass starts)."""
    width = -(-w * channels * depth // 8)
    if at + h * (width + 1) > len(data):
        raise Unreadable("too few lines")
    lines = np.frombuffer(data, np.uint8, h * (width + 1), at).reshape(h, width + 1)
    rows = unfiltered(lines[:, 1:], lines[:, 0], max(1, channels * depth // 8))
    if depth == 16:
        x = np.ascontiguousarray(rows).view(">u2")
    elif depth == 8:
        x = rows
    else:
        x = np.unpackbits(rows, axis=1).reshape(h, -1, depth) @ (1 << np.arange(depth - 1, -1, -1))
    return x[:, : w * channels].reshape(h, w, channels).astype(np.uint16), at + h * (width + 1)


def decoded(data: bytes | None) -> np.ndarray | None:
    """(h, w) gray, (h, w, 3) or (h, w, 4) bytes; None for what is no whole PNG image. Samples of 16 bits lose their lower half; gray with transparency becomes four channels."""
    try:
        return _decoded(data) if data else None
    except (Unreadable, zlib.error, struct.error, KeyError):
        return None


def _decoded(data: bytes) -> np.ndarray:
    head, palette, alpha, body = None, None, None, []
    for kind, chunk in _chunks(data):
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", chunk)
        elif kind == b"PLTE":
            palette = np.frombuffer(chunk, np.uint8).reshape(-1, 3) if len(chunk) % 3 == 0 else None
        elif kind == b"tRNS":
            alpha = chunk
        elif kind == b"IDAT":
            body.append(chunk)
    if head is None:
        raise Unreadable("no header")
    w, h, depth, colour, method, filters, laced = head
    if not w or not h or w * h > MOST_PIXELS or depth not in DEPTHS[colour] or method or filters or laced > 1:
        raise Unreadable("unknown kind")
    channels = CHANNELS[colour]
    most = (h + 8) * (-(-w * channels * depth // 8) + 1) + 8 * (h + w + 64)
    unpack = zlib.decompressobj()
    lines = unpack.decompress(b"".join(body), most)
    if laced:
        x, at = np.zeros((h, w, channels), np.uint16), 0
        for top, left, down, right in PASSES:
            rows, columns = -(-(h - top) // down), -(-(w - left) // right)
            if rows > 0 and columns > 0:
                x[top::down, left::right], at = _samples(lines, at, rows, columns, depth, channels)
    else:
        x, _ = _samples(lines, 0, h, w, depth, channels)
    if colour == 3:
        if palette is None or int(x.max()) >= len(palette):
            raise Unreadable("no such colour")
        table = palette if alpha is None else np.c_[palette, np.r_[np.frombuffer(alpha, np.uint8)[: len(palette)], np.full(max(0, len(palette) - len(alpha)), 255, np.uint8)]]
        return table[x[..., 0]]
    clear = None
    if alpha is not None and colour in (0, 2):
        clear = (x == np.frombuffer(alpha, ">u2")[:channels]).all(axis=2)
    full = (x >> 8 if depth == 16 else x * (255 // ((1 << depth) - 1))).astype(np.uint8)
    if colour == 4:
        return np.concatenate((np.repeat(full[..., :1], 3, axis=2), full[..., 1:]), axis=2)
    if clear is not None:
        return np.concatenate((np.repeat(full, 3, axis=2) if channels == 1 else full, np.where(clear, 0, 255).astype(np.uint8)[..., None]), axis=2)
    return full[..., 0] if channels == 1 else full
