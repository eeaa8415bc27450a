"""Page images: small numpy helpers, used on Arrow batches of pages.

Pixels are RGB rows of bytes (height * width * 3). Every stage keeps a page whole in its row; regions are cropped page by
page, so page bytes are never copied per region.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ANGLES = [round(i / 10 - 3, 1) for i in range(61)]
LEAST_ANGLE = 0.2


def rgb(pixels: bytes, width: int, height: int) -> np.ndarray:
    return np.frombuffer(pixels, np.uint8).reshape(height, width, 3)


def from_bgr(data: bytes, width: int, height: int, channels: int) -> bytes:
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.ascontiguousarray(x[..., [2, 1, 0]] if channels >= 3 else np.repeat(x[..., :1], 3, axis=2)).tobytes()


def rotated(gray: np.ndarray, degrees: float, fill: int = 255, smooth: bool = False) -> np.ndarray:
    """The picture turned counter-clockwise about its middle in its own frame."""
    h, w = gray.shape[:2]
    a = np.deg2rad(degrees)
    y, x = np.mgrid[0:h, 0:w].astype(np.float64)
    cy, cx = (h - 1) / 2, (w - 1) / 2
    sx = np.cos(a) * (x - cx) - np.sin(a) * (y - cy) + cx
    sy = np.sin(a) * (x - cx) + np.cos(a) * (y - cy) + cy
    if not smooth:
        ix, iy = np.rint(sx).astype(int), np.rint(sy).astype(int)
        inside = (ix >= 0) & (ix < w) & (iy >= 0) & (iy < h)
        out = np.full_like(gray, fill)
        out[inside] = gray[iy[inside], ix[inside]]
        return out
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)

    def weight(t: np.ndarray) -> np.ndarray:
        t = np.abs(t)
        return np.where(t < 1, 1.5 * t**3 - 2.5 * t**2 + 1, np.where(t < 2, -0.5 * t**3 + 2.5 * t**2 - 4 * t + 2, 0.0))

    out = np.zeros(gray.shape, np.float64)
    extra = (1,) * (gray.ndim - 2)
    for dy in range(-1, 3):
        for dx in range(-1, 3):
            ix, iy = np.clip(x0 + dx, 0, w - 1), np.clip(y0 + dy, 0, h - 1)
            out += gray[iy, ix] * (weight(sx - (x0 + dx)) * weight(sy - (y0 + dy))).reshape(h, w, *extra)
    inside = ((sx >= -0.5) & (sx <= w - 0.5) & (sy >= -0.5) & (sy <= h - 0.5)).reshape(h, w, *extra)
    return np.where(inside, np.clip(np.rint(out), 0, 255), fill).astype(np.uint8)


def skew(gray: np.ndarray) -> float:
    """The angle whose row sums vary most, the first among equals; 0 for an even page."""
    best, angle = 0.0, 0.0
    for a in ANGLES:
        score = float(rotated(gray, a, fill=0).sum(axis=1, dtype=np.float64).var())
        if score > best:
            best, angle = score, a
    return angle


def deskewed(page: np.ndarray) -> np.ndarray:
    gray = (page @ np.array([0.299, 0.587, 0.114])).astype(np.uint8)
    angle = skew(255 - gray)
    return rotated(page, angle, smooth=True) if abs(angle) > LEAST_ANGLE else page


def contrasted(page: np.ndarray, cutoff: float = 0.01) -> np.ndarray:
    """Each channel stretched to the full range, with a share of its darkest and brightest pixels cut."""
    out = np.empty_like(page)
    n = page.shape[0] * page.shape[1]
    for c in range(3):
        counts = np.cumsum(np.bincount(page[..., c].ravel(), minlength=256))
        low = int(np.searchsorted(counts, n * cutoff, side="right"))
        high = int(np.searchsorted(counts, n - n * cutoff, side="left"))
        table = np.arange(256.0) if high <= low else np.clip((np.arange(256) - low) * 255.0 / (high - low), 0, 255)
        out[..., c] = table.astype(np.uint8)[page[..., c]]
    return out


def sharpened(page: np.ndarray, percent: int = 120, threshold: int = 3) -> np.ndarray:
    """Unsharp mask of radius one: what differs enough from its surroundings moves away from them."""
    k = np.exp(-0.5 * np.arange(-2, 3) ** 2.0)
    k /= k.sum()
    x = page.astype(np.float64)
    pad = np.pad(x, ((2, 2), (2, 2), (0, 0)), mode="edge")
    rows = sum(k[i] * pad[i : i + x.shape[0]] for i in range(5))
    blur = sum(k[i] * rows[:, i : i + x.shape[1]] for i in range(5))
    diff = x - blur
    return np.clip(np.rint(np.where(np.abs(diff) >= threshold, x + diff * percent / 100, x)), 0, 255).astype(np.uint8)


def png(page: np.ndarray) -> bytes:
    h, w = page.shape[:2]
    raw = np.concatenate([np.zeros((h, 1), np.uint8), page.reshape(h, w * 3)], axis=1).tobytes()

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b"")


def scaled(page: np.ndarray, width: int) -> np.ndarray:
    """At most `width` across, by averages of the pixels that fall on each new one."""
    h, w = page.shape[:2]
    if w <= width:
        return page
    height = max(1, int(h * (width / w)))
    x = np.add.reduceat(page.astype(np.float64), np.arange(width) * w // width, axis=1) / np.diff(np.append(np.arange(width) * w // width, w))[None, :, None]
    edges = np.arange(height) * h // height
    x = np.add.reduceat(x, edges, axis=0) / np.diff(np.append(edges, h))[:, None, None]
    return np.clip(np.rint(x), 0, 255).astype(np.uint8)


PAGE = "page_id string, seq int, side string, width int, height int, pixels binary, error string, stem string"


def prepared(scans: DataFrame, single: bool = True, overlap: int = 10, deskew: bool = False, contrast: bool = True, sharpen: bool = True) -> DataFrame:
    """Decoded scans(stem, width, height, channels, bgr, error) as pages, split and cleaned as asked; a failed page has an error."""

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples():
                if r.error is not None:
                    out.append((r.stem, r.seq, None, None, None, None, r.error, r.stem))
                    continue
                try:
                    w, h = int(r.width), int(r.height)
                    whole = rgb(from_bgr(r.bgr, w, h, int(r.channels)), w, h)
                    mid = w // 2
                    parts = [(r.stem, None, whole)] if single else [(f"{r.stem}_L", "L", whole[:, : mid + overlap]), (f"{r.stem}_R", "R", whole[:, max(0, mid - overlap) :])]
                    for page_id, side, page in parts:
                        if deskew:
                            page = deskewed(page)
                        if contrast:
                            page = contrasted(page)
                        if sharpen:
                            page = sharpened(page)
                        out.append((page_id, r.seq, side, page.shape[1], page.shape[0], np.ascontiguousarray(page).tobytes(), None, r.stem))
                except Exception as e:
                    out.append((r.stem, r.seq, None, None, None, None, f"preparation failed: {e}", r.stem))
            yield pd.DataFrame(out, columns=["page_id", "seq", "side", "width", "height", "pixels", "error", "stem"])

    if "seq" not in scans.columns:
        scans = scans.withColumn("seq", F.lit(0))
    return scans.select("stem", "seq", "width", "height", "channels", "bgr", "error").mapInPandas(run, PAGE)


def crops(pages: DataFrame, regions: DataFrame) -> DataFrame:
    """(page_id, id, type, pixels as PNG) of regions(page_id, id, type, bbox): a page's boxes travel to its pixels."""
    boxes = regions.groupBy("page_id").agg(F.collect_list(F.struct("id", "type", "bbox")).alias("boxes"))

    def run(batches):
        for batch in batches:
            out = []
            for r in batch.itertuples():
                page = rgb(r.pixels, int(r.width), int(r.height))
                for b in r.boxes:
                    box = b["bbox"]
                    out.append((r.page_id, b["id"], b["type"], png(page[box["y"] : box["y"] + box["height"], box["x"] : box["x"] + box["width"]])))
            yield pd.DataFrame(out, columns=["page_id", "id", "type", "pixels"])

    return pages.where("error is null").join(boxes, "page_id").select("page_id", "width", "height", "pixels", "boxes").mapInPandas(run, "page_id string, id string, type string, pixels binary")


def data_uri(data, mime: str = "image/png"):
    """Bytes as a data URI; line breaks that base64 may insert go."""
    return F.concat(F.lit(f"data:{mime};base64,"), F.regexp_replace(F.base64(data), "[\r\n]", ""))
