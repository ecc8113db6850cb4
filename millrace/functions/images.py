"""Fingerprints of images: decoded, made grey, reduced to 16 x 16, hashed."""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Pixels up to which an image is decoded; larger ones have no fingerprint.
MOST_PIXELS = 1 << 26


def decode_png(b: bytes) -> np.ndarray:
    """Pixels (rows, columns, channels) of a PNG of 8 bits a channel that is not interlaced."""
    at, packed, palette, head = 8, [], None, None
    while at + 8 <= len(b):
        size, kind = struct.unpack(">I4s", b[at : at + 8])
        body = b[at + 8 : at + 8 + size]
        at += size + 12
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, dtype=np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            packed.append(body)
        elif kind == b"IEND":
            break
    width, height, depth, colour, _, _, interlaced = head
    if depth != 8 or interlaced or width * height > MOST_PIXELS:
        raise ValueError("form of PNG that is not read")
    channels = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    rows = np.frombuffer(zlib.decompress(b"".join(packed)), dtype=np.uint8).reshape(height, 1 + width * channels)
    out = np.zeros((height, width, channels), dtype=np.uint8)
    above = np.zeros((width, channels), dtype=np.int64)
    for y in range(height):
        rule, line = rows[y, 0], rows[y, 1:].reshape(width, channels).astype(np.int64)
        if rule == 1:
            line = np.cumsum(line, axis=0) & 255
        elif rule == 2:
            line = (line + above) & 255
        elif rule:  # of mean and of Paeth: each pixel needs the one before it
            left, corner = np.zeros(channels, dtype=np.int64), np.zeros(channels, dtype=np.int64)
            for x in range(width):
                if rule == 3:
                    guess = (left + above[x]) >> 1
                else:
                    p = left + above[x] - corner
                    a, c, d = abs(p - left), abs(p - above[x]), abs(p - corner)
                    guess = np.where((a <= c) & (a <= d), left, np.where(c <= d, above[x], corner))
                line[x] = left = (line[x] + guess) & 255
                corner = above[x]
        out[y] = above = line
    return palette[out[:, :, 0]] if colour == 3 else out


def decode_bmp(b: bytes) -> np.ndarray:
    """Pixels of an uncompressed BMP of 24 or 32 bits a pixel."""
    start, _, width, height, _, bits, packed = struct.unpack("<IIiiHHI", b[10:34])
    if packed or bits not in (24, 32) or width * abs(height) > MOST_PIXELS:
        raise ValueError("form of BMP that is not read")
    stride = (width * bits // 8 + 3) // 4 * 4
    rows = np.frombuffer(b, dtype=np.uint8, count=stride * abs(height), offset=start).reshape(abs(height), stride)[:, : width * bits // 8]
    pixels = rows.reshape(abs(height), width, bits // 8)[:, :, 2::-1]
    return pixels[::-1] if height > 0 else pixels


def grey(pixels: np.ndarray) -> np.ndarray:
    """Luma of colour pixels by the weights of ITU-R 601, in fixed point."""
    if pixels.shape[2] < 3:
        return pixels[:, :, 0]
    r, g, b = (pixels[:, :, k].astype(np.int64) for k in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


def _weights(size: int, out: int) -> np.ndarray:
    """Bicubic weights (a = -0.5) of each output pixel, widened when the image shrinks."""
    scale = size / out
    wide = max(scale, 1.0)
    table = np.zeros((out, size))
    for i in range(out):
        centre = (i + 0.5) * scale
        low, high = max(0, int(centre - 2 * wide + 0.5)), min(size, int(centre + 2 * wide + 0.5))
        x = np.abs((np.arange(low, high) - centre + 0.5) / wide)
        w = np.where(x < 1, (1.5 * x - 2.5) * x * x + 1, np.where(x < 2, ((-0.5 * x + 2.5) * x - 4) * x + 2, 0.0))
        table[i, low:high] = w / w.sum()
    return table


def reduced(pixels: np.ndarray, side: int = 16) -> np.ndarray:
    """A grey image of ``side`` x ``side``: rows first, then columns, each rounded to bytes."""
    step = lambda m: np.clip(np.floor(m + 0.5), 0, 255)
    across = step(pixels.astype(float) @ _weights(pixels.shape[1], side).T)
    return step(_weights(pixels.shape[0], side) @ across).astype(np.uint8)


def fingerprint(b: bytes | None) -> str | None:
    """SHA-1 of the reduced grey image; null for what is no PNG or BMP that can be read."""
    try:
        pixels = decode_png(b) if b[:8] == b"\x89PNG\r\n\x1a\n" else decode_bmp(b) if b[:2] == b"BM" else None
        return None if pixels is None else hashlib.sha1(reduced(grey(pixels)).tobytes()).hexdigest()
    except Exception:  # a broken image has no fingerprint
        return None


def image_fingerprint(content: Column) -> Column:
    """Fingerprints of image bytes, an Arrow batch at a time; compute them once per distinct file."""
    return F.pandas_udf(lambda s: pd.Series([fingerprint(b) for b in s], dtype=object), "string")(content)
