"""The walk over image bytes: sizes, and cut files at every length."""

import struct
import zlib

import pytest
from pyspark.sql import functions as F

from contentrisk.sources import image_headers as H


def png(w, h, data=b"x" * 40):
    def chunk(name, body):
        return struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    return H.PNG_SIGNATURE + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", data) + chunk(b"IEND", b"")


def jpeg(w, h):
    frame = b"\xff\xc2" + struct.pack(">HBHHB", 8 + 3, 8, h, w, 1) + b"\x01\x11\x00"
    scan = b"\xff\xda" + struct.pack(">H", 8) + b"\x01\x01\x00\x00\x3f\x00" + b"\x12\xff\x00\x34\xff\xd0\x99"
    thumb = b"\xff\xe1" + struct.pack(">H", 12) + b"\xff\xd9\xff\xc0\x00" + b"12345"       # marks inside a segment are data
    return b"\xff\xd8" + thumb + b"\xff" + frame + scan + scan + b"\xff\xd9"


def gif(w, h):
    return (b"GIF87a" + struct.pack("<HHBBB", w, h, 0x81, 0, 0) + b"\x00" * 12 + b"\x21\xfe\x03abc\x00"
            + b"\x2c" + struct.pack("<HHHHB", 0, 0, w, h, 0x80) + b"\x00" * 6 + b"\x02" + b"\x02\x3b\x3b" + b"\x00" + b"\x3b")


@pytest.mark.parametrize("kind, make", [("png", png), ("jpeg", jpeg), ("gif", gif)])
def test_sizes_and_every_cut(kind, make):
    b = make(640, 481)
    assert H.header_of(b) == (kind, 640, 481, True)
    assert H.header_of(b + b"more") == (kind, 640, 481, True)
    assert not any(H.header_of(b[:n])[3] for n in range(len(b)))


def test_other_bytes():
    for b in (None, b"", b"\x89PNG", b"<html>", b"\xff\xd8", b"\xff\xd8\xff", b"GIF89", b"GIF89a" + b"\x00" * 7, H.PNG_SIGNATURE + b"\xff" * 40, b"\xff\xd8\xff\x00\x00"):
        assert not H.header_of(b)[3]
    assert H.header_of(png(0, 5))[1:] == (None, None, False)


def test_column(spark):
    df = spark.createDataFrame([("p", bytes(png(3, 4))), ("j", bytes(jpeg(5, 6))), ("c", bytes(gif(7, 8))[:-1]), ("n", None)], "id string, content binary")
    got = {r.id: r.h for r in df.select("id", H.image_header(F.col("content")).alias("h")).collect()}
    assert tuple(got["p"]) == ("png", 3, 4, True) and tuple(got["j"]) == ("jpeg", 5, 6, True)
    assert tuple(got["c"]) == ("gif", 7, 8, False) and tuple(got["n"]) == (None, None, None, False)
    assert sorted(r.id for r in H.whole_images(df).collect()) == ["j", "p"] and H.whole_images(df.limit(0)).count() == 0
