"""Readings of decoded images: grey by fixed-point weights, brightness, contrast and blur, in Arrow batches with numpy."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: fixed values: weights of red, green and blue in 1/65536
WEIGHTS = {"red": 19595, "green": 38470, "blue": 7471}
READ = ["brightness", "contrast", "blur"]


def grey(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """8-bit grey of rows of bytes: one channel is grey already, three or four are blue, green, red and opacity."""
    px = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.int64)
    if channels == 1:
        return px[:, :, 0]
    blue, green, red = px[:, :, 0], px[:, :, 1], px[:, :, 2]
    return (WEIGHTS["red"] * red + WEIGHTS["green"] * green + WEIGHTS["blue"] * blue + 32768) >> 16


def edges(g: np.ndarray) -> np.ndarray:
    """3 x 3 filter, 8 in the middle and -1 around it, held within 0..255; the border stays as it is."""
    out = g.copy()
    if min(g.shape) > 2:
        around = sum(g[dy : dy + g.shape[0] - 2, dx : dx + g.shape[1] - 2] for dy in range(3) for dx in range(3))
        out[1:-1, 1:-1] = np.clip(9 * g[1:-1, 1:-1] - around, 0, 255)
    return out


def _moments(g: np.ndarray) -> tuple[float, float]:
    """Mean and population variance from whole sums."""
    n, s, q = g.size, int(g.sum()), int((g * g).sum())
    return s / n, (n * q - s * s) / (n * n)


def _read(keys: list[str]):
    def run(batches):
        for b in batches:
            out = []
            for height, width, channels, data in zip(*(b.column(c) for c in ("height", "width", "channels", "data")), strict=True):
                h, w, c = height.as_py(), width.as_py(), channels.as_py()
                # one image at a time leaves Arrow's buffer
                raw = data.as_buffer() if data.is_valid and h and w and c in (1, 3, 4) and min(h, w) > 0 else None
                if raw is None or raw.size != h * w * c:
                    out.append((None, None, None))
                    continue
                g = grey(raw, h, w, c)
                brightness, variance = _moments(g)
                out.append((brightness, variance**0.5, _moments(edges(g))[1]))
            read = [pa.array([r[k] for r in out], pa.float64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in [*keys, "width", "height"]] + read, [*keys, "width", "height", *READ])

    return run


def readings(images: DataFrame) -> DataFrame:
    """width, height, brightness, contrast and blur beside the other columns of ``images`` (height, width, channels, data).

    Contrast is the population deviation, blur the population variance after the edge filter. An image that couldn't be decoded, or whose
    data doesn't fit its size, has null readings; it is a row, not a failed job. Order of rows and repeated rows stay.
    """
    pixels = ["height", "width", "channels", "data"]
    keys = [c for c in images.columns if c not in [*pixels, *READ]]
    flat = images.select(*keys, *[F.col(c).cast("int").alias(c) for c in pixels[:3]], "data")
    kinds = ", ".join(f"`{c}` {images.schema[c].dataType.simpleString()}" for c in keys)
    schema = f"{kinds + ', ' if kinds else ''}width int, height int, brightness double, contrast double, blur double"
    read = flat.mapInArrow(_read(keys), schema)
    return read.withColumns({c: F.when(F.col("brightness").isNotNull(), F.col(c)) for c in ("width", "height")})


def sequence_sizes(read: DataFrame, sequence: str = "sequence", index: str = "frame_index") -> DataFrame:
    """(sequence, width, height): the size of a sequence is that of its lowest-index frame that could be decoded, null where there is none."""
    size = F.min_by(F.struct("width", "height"), F.when(F.col("width").isNotNull(), F.col(index)))
    return read.groupBy(sequence).agg(size.alias("_s")).select(sequence, "_s.width", "_s.height")


def png(rgb: np.ndarray) -> bytes:
    """The file of a picture of height x width x 3 bytes, or height x width of grey."""
    height, width = rgb.shape[:2]
    raw = np.concatenate([np.zeros((height, 1), np.uint8), rgb.astype(np.uint8).reshape(height, -1)], axis=1).tobytes()
    part = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    head = struct.pack(">IIBBBBB", width, height, 8, 2 if rgb.ndim == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(raw, 1)) + part(b"IEND", b"")
