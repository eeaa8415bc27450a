"""Width and height of an image from the first bytes of its file, as column expressions: no pixel is decoded.

PNG and TIFF say them at places that their headers name; in JPEG they follow the segments before the frame. Null for other
kinds and for broken headers.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Segments of a JPEG before its frame, and entries of a TIFF's directory, that are looked at.
SEGMENTS, ENTRIES = 1000, 4096


def _byte(content: Column, at: Column) -> Column:
    return F.conv(F.hex(F.substring(content, at.cast("int") + 1, F.lit(1))), 16, 10).cast("long")


def _number(content: Column, at: Column, n: int, little: Column | None = None) -> Column:
    """n bytes from place at (from 0) as a number, the high byte first unless little."""
    each = [_byte(content, at + i) for i in range(n)]
    big = reduce(lambda a, b: a * 256 + b, each)
    return big if little is None else F.when(little, reduce(lambda a, b: a * 256 + b, each[::-1])).otherwise(big)


def _size(width: Column, height: Column) -> Column:
    return F.when((width > 0) & (height > 0), F.struct(width.cast("int").alias("width"), height.cast("int").alias("height")))


def _png(content: Column) -> Column:
    return _size(_number(content, F.lit(16), 4), _number(content, F.lit(20), 4))


def _jpeg(content: Column) -> Column:
    """From segment to segment, each by its length, to the first that begins a frame."""

    def step(at: Column, _: Column) -> Column:
        kind = _byte(content, at + 1)
        frame = kind.between(0xC0, 0xCF) & ~kind.isin(0xC4, 0xC8, 0xCC)
        alone = kind.between(0xD0, 0xD9) | (kind == 1)
        on = F.when(kind == 0xFF, 1).when(alone, 2).otherwise(2 + _number(content, at + 2, 2))
        return F.when(at < 0, at).when(F.coalesce(_byte(content, at) != 0xFF, F.lit(True)), F.lit(-1).cast("long")).when(frame, -at).otherwise(at + on)

    # A frame's place is kept as a negative number, which ends the walk; -1 is none.
    end = F.aggregate(F.sequence(F.lit(1), F.lit(SEGMENTS)), F.lit(2).cast("long"), step)
    return F.when(end < -1, _size(_number(content, -end + 7, 2), _number(content, -end + 5, 2)))


def _tiff(content: Column) -> Column:
    little = F.substring(content, 1, 2) == F.lit(b"II")
    first = _number(content, F.lit(4), 4, little)
    n = F.least(_number(content, first, 2, little), F.lit(ENTRIES))

    def entry(i: Column) -> Column:
        at = first + 2 + 12 * i
        short = _number(content, at + 2, 2, little) == 3
        return F.struct(_number(content, at, 2, little).alias("tag"), F.when(short, _number(content, at + 8, 2, little)).otherwise(_number(content, at + 8, 4, little)).alias("value"))

    entries = F.when(n > 0, F.transform(F.sequence(F.lit(0).cast("long"), n - 1), entry))
    value = lambda tag: F.get(F.transform(F.filter(entries, lambda e: e["tag"] == tag), lambda e: e["value"]), 0)
    return _size(value(256), value(257))


def image_size(content: Column) -> Column:
    """struct(width, height) of the image that a file's bytes hold; of a TIFF's first page."""
    head = F.hex(F.substring(content, 1, 8))
    png, jpeg, tiff = head == "89504E470D0A1A0A", head.startswith("FFD8FF"), F.left(head, F.lit(8)).isin("49492A00", "4D4D002A")
    return F.when(png, _png(content)).when(jpeg, _jpeg(content)).when(tiff, _tiff(content))
