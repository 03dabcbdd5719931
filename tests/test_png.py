"""Every colour type, depth, filter and interlacing against an encoder written from the format's definition."""

import struct
import zlib

import numpy as np
import pytest

from ruleforge.functions import images, raster
from ruleforge.functions import png as m
from ruleforge.plans import puzzles
from ruleforge.sources import files


def chunk(kind, data):
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def packed(samples, depth):
    """(h, w * channels) samples as rows of bytes, bit by bit."""
    out = []
    for row in samples.reshape(samples.shape[0], -1):
        bits = "".join(format(int(v), f"0{depth}b") for v in row)
        bits += "0" * (-len(bits) % 8)
        out.append(bytes(int(bits[i : i + 8], 2) for i in range(0, len(bits), 8)))
    return out


def filtered(rows, step, kinds):
    out, before = b"", bytes(len(rows[0]) if rows else 0)
    for row, kind in zip(rows, kinds, strict=True):
        line = []
        for i, x in enumerate(row):
            a = row[i - step] if i >= step else 0
            b = before[i]
            c = before[i - step] if i >= step else 0
            p = a + b - c
            paeth = min(((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c)))[2]
            line.append((x - (0, a, b, (a + b) // 2, paeth)[kind]) % 256)
        out += bytes([kind]) + bytes(line)
        before = row
    return out


def encoded(samples, colour, depth, rng, laced=False, extra=b""):
    h, w = samples.shape[:2]
    channels = m.CHANNELS[colour]
    step = max(1, channels * depth // 8)
    lines = b""
    for top, left, down, right in m.PASSES if laced else ((0, 0, 1, 1),):
        part = samples[top::down, left::right]
        if part.size:
            lines += filtered(packed(part, depth), step, rng.integers(0, 5, part.shape[0]).tolist())
    data = zlib.compress(lines)
    return m.SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, depth, colour, 0, 0, int(laced))) + extra + chunk(b"IDAT", data[:7]) + chunk(b"IDAT", data[7:]) + chunk(b"IEND", b"")


@pytest.mark.parametrize("laced", [False, True])
@pytest.mark.parametrize(("colour", "depth"), [(c, d) for c, ds in m.DEPTHS.items() for d in ds])
def test_every_kind(colour, depth, laced):
    rng = np.random.default_rng(colour * 100 + depth)
    for h, w in ((1, 1), (5, 3), (13, 22)):
        x = rng.integers(0, min(1 << depth, 200) if colour == 3 else 1 << depth, (h, w, m.CHANNELS[colour]))
        palette = rng.integers(0, 256, (200, 3), dtype=np.uint8)
        extra = chunk(b"PLTE", palette.tobytes()) if colour == 3 else b""
        got = m.decoded(encoded(x, colour, depth, rng, laced, extra))
        full = (x >> 8 if depth == 16 else x * 255 // ((1 << depth) - 1)).astype(np.uint8)
        expected = {0: full[..., 0], 2: full, 3: palette[np.minimum(x[..., 0], 199)], 4: np.concatenate((np.repeat(full[..., :1], 3, axis=2), full[..., -1:]), axis=2), 6: full}[colour]
        assert got.dtype == np.uint8 and (got == expected).all()


def test_transparency():
    rng = np.random.default_rng(1)
    x = np.array([[[3], [0]], [[1], [2]]])
    assert m.decoded(encoded(x, 0, 2, rng, extra=chunk(b"tRNS", struct.pack(">H", 1))))[..., 3].tolist() == [[255, 255], [0, 255]]
    palette = chunk(b"PLTE", bytes(range(12))) + chunk(b"tRNS", bytes([9, 8]))
    assert m.decoded(encoded(x, 3, 2, rng, extra=palette)).tolist() == [[[9, 10, 11, 255], [0, 1, 2, 9]], [[3, 4, 5, 8], [6, 7, 8, 255]]]


def test_broken_files_are_null():
    rng = np.random.default_rng(2)
    good = encoded(rng.integers(0, 256, (6, 7, 3)), 2, 8, rng)
    assert m.decoded(good) is not None
    for bad in (None, b"", b"GIF89a", good[:-1], good[:40], good[:60] + bytes([good[60] ^ 1]) + good[61:], good.replace(b"IHDR", b"IHDX"), encoded(rng.integers(0, 4, (3, 3, 1)), 3, 2, rng)):
        assert m.decoded(bad) is None


def test_sheets_read_back():
    x = np.random.default_rng(3).integers(0, 256, (40, 30, 3)).astype(np.uint8)
    assert (m.decoded(raster.png(x)) == x).all()


def test_folders_to_flags(spark, tmp_path):
    """Attempt folders of PNG files of all kinds: hashes equal those of the pixels, copies and blank images are found, broken files are counted."""
    rng = np.random.default_rng(4)
    pictures = {i: rng.integers(0, 256, (24, 24, 3)).astype(np.uint8) for i in range(40)}
    rows, seen = [], {}
    for i in range(4):
        for k in range(8):
            x = pictures[8 * i + (0 if i == 1 and k < 3 else k)]
            x = np.full_like(x, 250) if (i, k) == (2, 5) else x
            data = b"broken" if (i, k) == (3, 1) else encoded(x.astype(int), 2, 8, rng, laced=k % 2 == 0)
            path = f"{i}_1/output_{'correct' if k < 5 else 'incorrect'}/{k}.png"
            seen[path] = None if data == b"broken" else images.phash(x)
            rows.append((path, data))
        rows.append((f"{i}_1/test_result.txt", b"success"))
    written = files.write_files(spark.createDataFrame(rows, "path string, content binary").repartition(3), str(tmp_path))
    assert written.filter("error is not null").count() == 0
    got = images.hashed_files(spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(str(tmp_path)).filter("path like '%.png'")).collect()
    assert {r.path.split(f"{tmp_path}/")[1]: r.phash for r in got} == seen and all(r.height == r.width == 24 for r in got if r.phash)
    flags = {r.id: (r.has_duplicate, r.has_blank, r.unreadable) for r in puzzles.folder_flags(spark, str(tmp_path)).collect()}
    assert flags == {0: (False, False, 0), 1: (True, False, 0), 2: (False, True, 0), 3: (False, False, 1)}
