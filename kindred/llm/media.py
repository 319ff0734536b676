"""Text payloads as media columns: lossless WebP images, written and read back in the tasks that read the texts."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm import webp
from kindred.llm.common import text_of

WIDTH, UNIT = 64, 64
#: Bytes in an image; a longer payload is stored as several images one after another.
TILE = WIDTH * 4096
#: References are sought where they leave so much of the size at most; the search costs more than the rest together.
PAYS = 0.8
LEVELS = np.arange(256)


def payload(text: str) -> tuple[int, bytes]:
    """The text's UTF-8 bytes, and they with zeros up to a positive multiple of 64."""
    raw = text.encode("utf-8", "surrogatepass")
    return len(raw), raw + bytes(-len(raw) % UNIT if raw else UNIT)


def _refers(data: bytes) -> bool:
    """Whether references pay, as a fast compressor has it with and without them."""
    plain = zlib.compressobj(1, wbits=-15, strategy=zlib.Z_HUFFMAN_ONLY)
    return len(zlib.compress(data, 1, -15)) < PAYS * len(plain.compress(data) + plain.flush())


def encoded(x: np.ndarray) -> bytes:
    """A grey image (rows of WIDTH bytes) in the form of those that may pay that is shortest. Grey leaves one channel
    after red and blue have lost green; equal runs of it refer back where that shortens it enough. A palette, which packs
    pixels, is tried up to 16 levels, and a prediction from the left or from above where its rest is more alike. With one
    channel alone neither cross-colour nor a colour cache can pay."""
    pixels = np.empty((*x.shape, 4), np.uint8)
    pixels[..., :3], pixels[..., 3] = x[..., None], 255
    forms: list[dict] = [{"transforms": (webp.GREEN,)}]
    counts = np.bincount(x.ravel(), minlength=256)
    if np.count_nonzero(counts) <= 16:
        forms.append({"transforms": (webp.PALETTE,)})
    # chances that two bytes drawn are equal
    steps = [np.bincount(np.diff(x, axis=a).ravel(), minlength=256) for a in (1, 0)]
    rest, mode = max((float(n @ n) / max(1, n.sum()) ** 2, k) for k, n in enumerate(steps, 1))
    if rest > 1.5 * float(counts @ counts) / x.size**2:
        forms.append({"transforms": (webp.GREEN, webp.PREDICTOR), "block": 9, "modes": np.asarray(mode)})
    refers = _refers(x.tobytes())
    return min((webp.encode(pixels, references=refers, **f) for f in forms), key=len)


def store(data: bytes) -> bytes:
    """Grey images of WIDTH bytes a row."""
    return b"".join(encoded(np.frombuffer(data[at : at + TILE], np.uint8).reshape(-1, WIDTH)) for at in range(0, len(data), TILE))


def read(stored: bytes) -> list[np.ndarray]:
    """The pixel arrays of images one after another."""
    out, at = [], 0
    while at < len(stored):
        size = struct.unpack("<I", stored[at + 4 : at + 8])[0] + 8
        out.append(webp.decode(stored[at : at + size]))
        at += size
    return out


def back(pixels: list[np.ndarray]) -> np.ndarray:
    """The payload's bytes, rows of WIDTH, from grey images' pixel arrays."""
    for p in pixels:
        if (p.view("<u4")[..., 0] != p[..., 1] * np.uint32(0x10101) + np.uint32(0xFF000000)).any():
            raise ValueError("not a grey image")
    return np.concatenate([p[..., 1] for p in pixels])


def feature(x: np.ndarray, images: int) -> str:
    """Images, pixels, mean, standard deviation, mean step to the next pixel, and the commonest of 16 levels with its
    share."""
    n = np.bincount(x.ravel(), minlength=256)
    mean, level = float(n @ LEVELS) / x.size, n.reshape(16, 16).sum(axis=1)
    step = np.maximum(x[:, 1:], x[:, :-1]) - np.minimum(x[:, 1:], x[:, :-1])
    values = (mean, max(0.0, float(n @ LEVELS**2) / x.size - mean**2) ** 0.5, float(step.sum(dtype=np.int64)) / step.size)
    return f"{images}|{x.size}|" + ",".join(f"{v:.3f}" for v in values) + f"|{level.argmax()}:{level.max() / x.size:.4f}"


def _row(text: str) -> tuple:
    n, data = payload(text)
    stored = store(data)
    pixels = read(stored)
    x = back(pixels)
    got = x.tobytes()
    return n, len(got), hashlib.sha256(got).hexdigest(), zlib.crc32(got[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(x, len(pixels)), stored


def _stored(keep: bool):
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.binary()]
    names = ["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                columns = list(zip(*(_row(t.as_py()) for t in part.column("text"))))[: 7 + keep]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", *names[: 7 + keep]])

    return run


def store_media(docs: DataFrame, keep: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each input row: doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256, feature, and with ``keep`` the stored ``media``.

    Null text is empty text, whose payload is 64 zeros; payloads above TILE bytes become several images. The hashes
    are of bytes that were read back from the stored form. Equal texts have equal values; rows that repeat an id or
    have none are rows of their own; an empty table gives an empty result; other columns, whatever their names, are
    not read."""
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text"))
    schema = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return plain.mapInArrow(_stored(keep), schema + ", media binary" * keep)
