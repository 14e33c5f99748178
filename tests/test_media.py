"""Image fingerprints: equal images group together, an invalid file is the NULL group."""

import os
import struct
import zlib

from pyspark.sql import functions as F

from valuescope.operators.fingerprint import fingerprint_histogram, top_fingerprints
from valuescope.sources.media import image_fingerprints, read_images


def _png(path, width, height, pixel):
    raw = b"".join(b"\x00" + b"".join(bytes(pixel(x, y)) for x in range(width)) for y in range(height))

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)

    with open(path, "wb") as f:
        f.write(b"\x89PNG\r\n\x1a\n")
        f.write(chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, 2, 0, 0, 0)))
        f.write(chunk(b"IDAT", zlib.compress(raw)))
        f.write(chunk(b"IEND", b""))


def test_image_fingerprint_groups(spark, tmp_dir):
    def grad(x, y):
        return ((x * 4) % 256, (y * 4) % 256, ((x + y) * 2) % 256)

    def other(x, y):
        return ((255 - x * 3) % 256, (x * y) % 256, (y * 7) % 256)

    _png(os.path.join(tmp_dir, "a.png"), 64, 48, grad)
    _png(os.path.join(tmp_dir, "b.png"), 64, 48, grad)
    _png(os.path.join(tmp_dir, "c.png"), 64, 48, other)
    with open(os.path.join(tmp_dir, "d.png"), "wb") as f:
        f.write(b"not an image")
    prints = image_fingerprints(read_images(spark, tmp_dir))
    by_name = {os.path.basename(r["origin"]): r["fingerprint"] for r in prints.collect()}
    assert by_name["a.png"] == by_name["b.png"] and by_name["a.png"] is not None
    assert by_name["c.png"] != by_name["a.png"]
    assert by_name["d.png"] is None
    hist = {r["fingerprint"]: r["count"] for r in fingerprint_histogram(prints).collect()}
    assert hist[by_name["a.png"]] == 2 and hist[None] == 1
    top = top_fingerprints(prints, 1).first()
    assert top["count"] == 2
    assert prints.where(F.col("fingerprint8").isNotNull()).count() == 3


def test_vector_fingerprint_rule(spark):
    from valuescope.functions.vectors import fingerprint64, fold8, median_bits
    df = spark.createDataFrame([([1.0, 5.0, 3.0, 7.0],)], "v array<float>")
    r = df.select(median_bits("v").alias("b"), fingerprint64("v").alias("f"), fold8("v").alias("g")).first()
    assert r["b"] == [False, True, False, True]  # median 4.0
    assert r["f"] == (1 << 1) | (1 << 3) and r["g"] == (1 << 1) + (1 << 3)


def test_media_duplicates_job(spark, tmp_dir):
    from valuescope import jobs

    def flat(x, y):
        return (x % 256, x % 256, x % 256)

    for name in ("p.png", "q.png", "r.png"):
        _png(os.path.join(tmp_dir, name), 40, 30, flat)
    top = jobs.media_duplicates(spark, tmp_dir, k=5).collect()
    assert top[0]["count"] == 3 and len(top) == 1
