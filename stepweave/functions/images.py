"""Images as raw (height, width, 3) bytes or PNG: resizing, filling in, writing. No imaging library is needed."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from stepweave.schemas import IMAGE_SIDE
from stepweave.sources.files import file_system

_PNG = b"\x89PNG\r\n\x1a\n"


def png_encode(image: np.ndarray) -> bytes:
    """An 8-bit RGB PNG."""
    h, w = image.shape[:2]
    rows = np.zeros((h, 1 + w * 3), np.uint8)
    rows[:, 1:] = image.reshape(h, w * 3)
    chunk = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    return _PNG + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def png_decode(data: bytes) -> np.ndarray:
    """An 8-bit RGB, RGBA or gray PNG without interlacing, as RGB."""
    at, parts, head = 8, [], None
    while at < len(data):
        size, kind = struct.unpack(">I4s", data[at : at + 8])
        body = data[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            parts.append(body)
        at += 12 + size
    if head is None or head[2] != 8 or head[6] != 0 or head[3] not in (0, 2, 6):
        raise ValueError("this kind of PNG is not read")
    w, h, bpp = head[0], head[1], {0: 1, 2: 3, 6: 4}[head[3]]
    raw = np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(h, 1 + w * bpp)
    out = np.zeros((h, w * bpp), np.int32)
    for y in range(h):
        kind, line = raw[y, 0], raw[y, 1:].astype(np.int32)
        up = out[y - 1] if y else np.zeros(w * bpp, np.int32)
        if kind in (0, 2):
            out[y] = (line + (up if kind == 2 else 0)) & 255
            continue
        for x in range(w * bpp):
            a = out[y, x - bpp] if x >= bpp else 0
            b, c = up[x], up[x - bpp] if x >= bpp else 0
            if kind == 1:
                p = a
            elif kind == 3:
                p = (a + b) // 2
            else:
                d = a + b - c
                p = min(((abs(d - a), 0, a), (abs(d - b), 1, b), (abs(d - c), 2, c)))[2]
            out[y, x] = (line[x] + p) & 255
    pixels = out.astype(np.uint8).reshape(h, w, bpp)
    return np.repeat(pixels, 3, axis=2) if bpp == 1 else pixels[:, :, :3]


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, centres aligned."""
    h, w = image.shape[:2]
    if (h, w) == (height, width):
        return image
    ys = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    xs = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = np.floor(ys).astype(int), np.floor(xs).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    fy, fx = (ys - y0)[:, None, None], (xs - x0)[None, :, None]
    im = image.astype(np.float64)
    top = im[y0][:, x0] * (1 - fx) + im[y0][:, x1] * fx
    low = im[y1][:, x0] * (1 - fx) + im[y1][:, x1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def decoded(data: bytes) -> np.ndarray:
    """The pixels of PNG, JPEG (if Pillow is there) or raw square bytes, as RGB."""
    if data[:8] == _PNG:
        return png_decode(data)
    if image_type(data):
        try:
            from PIL import Image
        except ImportError as e:
            raise NotImplementedError("reading JPEG needs the package Pillow") from e
        import io

        return np.asarray(Image.open(io.BytesIO(data)).convert("RGB"))
    edge = _edge(data)
    if not edge:
        raise ValueError("neither PNG, JPEG nor a raw square image")
    im = np.frombuffer(data, np.uint8).reshape(edge, edge, -1)
    return np.repeat(im, 3, axis=2) if im.shape[2] == 1 else im


def as_rgb(data: bytes | None, side: int = IMAGE_SIDE) -> np.ndarray:
    """(side, side, 3): black for nothing; gray becomes RGB; PNG or raw square images are resized."""
    if not data:
        return np.zeros((side, side, 3), np.uint8)
    return resized(decoded(data), side, side)


def encoded(data: bytes) -> bytes:
    """What models take: PNG and JPEG as they are, a raw square image as PNG."""
    return data if image_type(data) or not data else png_encode(as_rgb(data, max(1, _edge(data))))


def image_type(data: bytes) -> str | None:
    """The media type of PNG and JPEG bytes."""
    return "image/png" if data[:8] == _PNG else "image/jpeg" if data[:3] == b"\xff\xd8\xff" else None


def _edge(data: bytes) -> int:
    """Pixels of a side of a raw square image; 0 for anything else."""
    edges = ((round((len(data) / c) ** 0.5), c) for c in (3, 1))
    return next((e for e, c in edges if e * e * c == len(data)), 0)


def ensured(image: Column, side: int = IMAGE_SIDE) -> Column:
    """:func:`as_rgb` over a column, as raw bytes."""

    @F.pandas_udf("binary")
    def run(images: pd.Series) -> pd.Series:
        return pd.Series([as_rgb(None if d is None else bytes(d), side).tobytes() for d in images])

    return run(image)


def loaded(image: Column, path: Column) -> Column:
    """The image itself, else the bytes of the file at ``path``; NULL without either, or where the file is missing."""

    @F.pandas_udf("binary")
    def run(images: pd.Series, paths: pd.Series) -> pd.Series:
        def one(data, at):
            if data is not None and len(data):
                return data
            if not at:
                return None
            where, inner = file_system(at)
            try:
                with where.open_input_file(inner) as f:
                    return f.read()
            except FileNotFoundError:
                return None

        return pd.Series([one(d, p) for d, p in zip(images, paths)], dtype=object)

    return run(image, path)


def base64_text(image: Column) -> Column:
    """An image as models take it over a network: PNG or JPEG bytes in base64; raw square images become PNG."""

    @F.pandas_udf("binary")
    def run(images: pd.Series) -> pd.Series:
        return pd.Series([encoded(bytes(d)) if d is not None and len(d) else None for d in images], dtype=object)

    return F.base64(run(image))


def sized(image: Column, height: int, width: int) -> Column:
    """Images of any readable kind as raw (height, width, 3) bytes; NULL and empty ones stay, JPEG needs Pillow."""

    @F.pandas_udf("binary")
    def run(images: pd.Series) -> pd.Series:
        return pd.Series([resized(decoded(bytes(d)), height, width).tobytes() if d is not None and len(d) else d for d in images], dtype=object)

    return run(image)


def has_content(image: Column) -> Column:
    """Whether a raw image has any byte but 0; NULL and empty ones have none."""

    @F.pandas_udf("boolean")
    def run(images: pd.Series) -> pd.Series:
        return pd.Series([bool(d) and bytes(d).strip(b"\0") != b"" for d in images], dtype=bool)

    return run(image)


def write_png(path: str, data: bytes) -> None:
    with open(path, "wb") as f:
        f.write(data if data[:8] == _PNG else png_encode(as_rgb(data, round((len(data) / 3) ** 0.5))))
