"""Kind, size and completeness of landed images, by a walk over their bytes.

No decoder is needed to tell how large an image is and whether the file is whole: PNG chunks, JPEG
segments and GIF blocks say how long they are, so a walk from one to the next either comes to the
end mark or runs out of bytes. The walk touches a few bytes a chunk; pixels are never read.
"""

from __future__ import annotations

import struct

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

HEADER = T.StructType([T.StructField("kind", T.StringType()), T.StructField("width", T.IntegerType()),
                       T.StructField("height", T.IntegerType()), T.StructField("whole", T.BooleanType())])

# Fixed values of the three formats.
PNG_SIGNATURE = b"\x89PNG\r\n\x1a\n"
JPEG_START, JPEG_END = 0xD8, 0xD9
JPEG_FRAMES = {0xC0, 0xC1, 0xC2, 0xC3, 0xC5, 0xC6, 0xC7, 0xC9, 0xCA, 0xCB, 0xCD, 0xCE, 0xCF}
JPEG_ALONE = {0x01, *range(0xD0, 0xD8)}      # markers without a length
JPEG_SCAN = 0xDA
GIF_SIGNATURES = (b"GIF87a", b"GIF89a")
GIF_END, GIF_EXTENSION, GIF_IMAGE = 0x3B, 0x21, 0x2C

Header = tuple[str | None, int | None, int | None, bool]


def png(b: bytes) -> Header:
    """Chunks: length, name, data, check sum; the first is IHDR, the last IEND."""
    at, size = len(PNG_SIGNATURE), (None, None)
    while at + 12 <= len(b):
        n, name = struct.unpack_from(">I4s", b, at)
        if name == b"IHDR" and n >= 8 and at + 16 <= len(b):
            size = struct.unpack_from(">ii", b, at + 8)   # the format's limit is 2^31 - 1
            size = size if min(size) > 0 else (None, None)
        at += 12 + n
        if name == b"IEND":
            return ("png", *size, size[0] is not None and at <= len(b))
    return ("png", *size, False)


def jpeg(b: bytes) -> Header:
    """Segments: marker and length; behind a scan's header its data, up to a marker that is no filler."""
    at, size = 2, (None, None)
    while at + 2 <= len(b):
        if b[at] != 0xFF:
            return ("jpeg", *size, False)
        marker = b[at + 1]
        if marker == 0xFF:      # fill bytes
            at += 1
            continue
        if marker == JPEG_END:
            return ("jpeg", *size, size[0] is not None)
        if marker in JPEG_ALONE:
            at += 2
            continue
        if at + 4 > len(b):
            break
        n = struct.unpack_from(">H", b, at + 2)[0]
        if marker in JPEG_FRAMES and at + 9 <= len(b):
            height, width = struct.unpack_from(">HH", b, at + 5)
            size = (width, height)
        at += 2 + n
        if marker == JPEG_SCAN:
            while True:
                at = b.find(b"\xff", at)
                if at < 0 or at + 1 >= len(b):
                    return ("jpeg", *size, False)
                if b[at + 1] != 0 and not 0xD0 <= b[at + 1] <= 0xD7:
                    break
                at += 2
    return ("jpeg", *size, False)


def gif(b: bytes) -> Header:
    """The screen's size, a colour table, then extensions and images of sub-blocks, up to the trailer."""
    if len(b) < 13:
        return ("gif", None, None, False)
    width, height, packed = struct.unpack_from("<HHB", b, 6)
    at = 13 + (3 << ((packed & 7) + 1) if packed & 0x80 else 0)
    while at < len(b):
        block = b[at]
        if block == GIF_END:
            return ("gif", width, height, True)
        if block == GIF_EXTENSION:
            at += 2
        elif block == GIF_IMAGE and at + 10 <= len(b):
            flags = b[at + 9]
            at += 10 + (3 << ((flags & 7) + 1) if flags & 0x80 else 0) + 1
        else:
            break
        while at < len(b) and b[at]:    # sub-blocks, the last of length 0
            at += 1 + b[at]
        at += 1
    return ("gif", width, height, False)


def header_of(b: bytes | None) -> Header:
    if not b:
        return (None, None, None, False)
    if b.startswith(PNG_SIGNATURE):
        return png(b)
    if b[0] == 0xFF and b[1:3] == bytes([JPEG_START, 0xFF]):
        return jpeg(b)
    if b.startswith(GIF_SIGNATURES):
        return gif(b)
    return (None, None, None, False)


@pandas_udf(HEADER)
def _headers(content: pd.Series) -> pd.DataFrame:
    rows = pd.DataFrame([header_of(b) for b in content], columns=HEADER.fieldNames())
    return rows.astype({"width": "Int32", "height": "Int32"})


def image_header(content: Column) -> Column:
    """(kind, width, height, whole) of an image's bytes; kind is null for anything else."""
    return _headers(content)


def whole_images(files: DataFrame, content_col: str = "content", out_col: str = "header") -> DataFrame:
    """``files`` whose bytes are a whole image, with its header: cut files and other bytes give no record."""
    return files.withColumn(out_col, image_header(F.col(content_col))).where(F.col(f"{out_col}.whole"))
