"""Pictures of eight bits a channel as bytes of red, green, blue and alpha, row by row."""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Fixed values of the format: its first bytes, and channels by colour type (without palettes).
SIGNATURE, CHANNELS = b"\x89PNG\r\n\x1a\n", {0: 1, 2: 3, 4: 2, 6: 4}


def chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def encoded(wide: int, high: int, pixels: bytes) -> bytes:
    rows = np.frombuffer(pixels, np.uint8).reshape(high, wide * 4)
    plain = np.concatenate((np.zeros((high, 1), np.uint8), rows), axis=1).tobytes()
    head = struct.pack(">IIBBBBB", wide, high, 8, 6, 0, 0, 0)
    return SIGNATURE + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(plain, 6)) + chunk(b"IEND", b"")


def paeth(left: int, up: int, corner: int) -> int:
    guess = left + up - corner
    a, b, c = abs(guess - left), abs(guess - up), abs(guess - corner)
    return left if a <= b and a <= c else up if b <= c else corner


def unfiltered(kind: int, row: bytearray, above: bytes, step: int) -> bytearray:
    if kind == 2:
        return bytearray(((np.frombuffer(row, np.uint8) + np.frombuffer(above, np.uint8)) & 255).astype(np.uint8).tobytes())
    if kind == 1:
        for k in range(step):  # channels apart: a running sum
            row[k::step] = np.cumsum(np.frombuffer(row, np.uint8)[k::step], dtype=np.uint8).tobytes()
    elif kind in (3, 4):
        for i in range(len(row)):
            left, corner = (row[i - step], above[i - step]) if i >= step else (0, 0)
            row[i] = row[i] + (left + above[i] >> 1 if kind == 3 else paeth(left, above[i], corner)) & 255
    elif kind:
        raise ValueError("unknown filter")
    return row


def decoded(raw: bytes) -> tuple[int, int, bytes]:
    """Width, height and pixels. Palettes, other depths and interlaced pictures are errors."""
    if raw[:8] != SIGNATURE:
        raise ValueError("no such picture")
    at, body, head = 8, b"", None
    while at + 8 <= len(raw):
        size, kind = struct.unpack_from(">I4s", raw, at)
        data = raw[at + 8 : at + 8 + size]
        head, body = (struct.unpack(">IIBBBBB", data), body) if kind == b"IHDR" else (head, body + data if kind == b"IDAT" else body)
        at += 12 + size
    if head is None or head[2] != 8 or head[3] not in CHANNELS or head[6]:
        raise ValueError("a kind of picture that isn't read")
    wide, high, step = head[0], head[1], CHANNELS[head[3]]
    plain, line = zlib.decompress(body), wide * step
    above, rows = bytes(line), []
    for y in range(high):
        first = y * (line + 1)
        above = bytes(unfiltered(plain[first], bytearray(plain[first + 1 : first + 1 + line]), above, step))
        rows.append(np.frombuffer(above, np.uint8).reshape(wide, step))
    flat = np.stack(rows)
    colour = flat[..., :3] if step > 2 else np.repeat(flat[..., :1], 3, axis=2)
    alpha = flat[..., -1:] if step in (2, 4) else np.full((high, wide, 1), 255, np.uint8)
    return wide, high, np.concatenate((colour, alpha), axis=2).tobytes()
