"""Media scan and perceptual fingerprints of stored images.

Images are read with Spark's ``image`` source (decoded on the executors; an
undecodable file is a row with width -1 and empty data). The fingerprint is a
DCT perceptual hash computed in an Arrow-batched pandas UDF with numpy:

* grey levels with the integer ITU-R 601 luma (R*19595 + G*38470 + B*7471 + 2^15) >> 16;
* an antialiasing Lanczos-3 downscale to 32x32 done as two separable passes
  (horizontal, then vertical) with coefficients normalised per output pixel,
  rounded to 22-bit fixed point, and 8-bit rounding/clipping after each pass --
  the method of the common Python imaging library's resize (not checked against
  it here: it is not installed);
* 2-D DCT-II, the top-left 8x8 coefficients, one bit per coefficient above their
  median.

The 64 bits become a signed 64-bit integer (first coefficient = most significant
bit, i.e. the hexadecimal form of the hash read as a number); the lossy
compatibility value is sum(2^(i mod 8)) over set bits. Invalid images give NULL.

Fetching media over HTTP inside tasks is not done: images are read from storage.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

HASH_SIZE = 8
RESIZE = 32


def read_images(spark: SparkSession, path: str, drop_invalid: bool = False) -> DataFrame:
    """(origin, image struct) rows; with ``drop_invalid`` undecodable files are dropped."""
    df = spark.read.format("image").option("dropInvalid", str(drop_invalid).lower()).load(path)
    return df.select(F.col("image.origin").alias("origin"), "image")


def _dct_matrix(n: int) -> np.ndarray:
    k = np.arange(n)[:, None]
    i = np.arange(n)[None, :]
    return 2.0 * np.cos(np.pi * k * (2 * i + 1) / (2 * n))


_DCT = _dct_matrix(RESIZE)


_PRECISION_BITS = 22
_LANCZOS_SUPPORT = 3.0


def _lanczos(x: np.ndarray) -> np.ndarray:
    x = np.abs(x)
    out = np.sinc(x) * np.sinc(x / _LANCZOS_SUPPORT)
    return np.where(x < _LANCZOS_SUPPORT, out, 0.0)


def _resample_matrix(in_size: int, out_size: int) -> np.ndarray:
    """(out_size, in_size) integer fixed-point weights of one antialiasing pass."""
    scale = in_size / out_size
    filterscale = max(scale, 1.0)
    support = _LANCZOS_SUPPORT * filterscale
    weights = np.zeros((out_size, in_size), dtype=np.int64)
    for xx in range(out_size):
        center = (xx + 0.5) * scale
        xmin = max(int(center - support + 0.5), 0)
        xmax = min(int(center + support + 0.5), in_size)
        xs = np.arange(xmin, xmax)
        k = _lanczos((xs - center + 0.5) / filterscale)
        total = k.sum()
        if total != 0.0:
            k = k / total
        scaled = k * (1 << _PRECISION_BITS)
        weights[xx, xmin:xmax] = np.where(scaled < 0, np.trunc(scaled - 0.5), np.trunc(scaled + 0.5))
    return weights


def _pass(pixels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    acc = pixels.astype(np.int64) @ weights.T + (1 << (_PRECISION_BITS - 1))
    return np.clip(acc >> _PRECISION_BITS, 0, 255)


def _antialias_resize(gray: np.ndarray, size: int) -> np.ndarray:
    """uint8 grey (h, w) -> (size, size), horizontal pass then vertical pass."""
    h, w = gray.shape
    out = gray.astype(np.int64)
    if w != size:
        out = _pass(out, _resample_matrix(w, size))            # (h, size)
    if h != size:
        out = _pass(out.T, _resample_matrix(h, size)).T         # (size, size)
    return out.astype(np.float64)


def phash_bits(height: int, width: int, channels: int, data: bytes) -> np.ndarray | None:
    """64 booleans for one decoded image (BGR[A] bytes, row-major), None if invalid."""
    if height is None or width is None or height <= 0 or width <= 0 or not data:
        return None
    arr = np.frombuffer(bytes(data), dtype=np.uint8)
    if arr.size != height * width * channels:
        return None
    px = arr.reshape(height, width, channels).astype(np.int64)
    if channels >= 3:  # Spark stores BGR(A)
        b, g, r = px[..., 0], px[..., 1], px[..., 2]
        gray = (r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16
    else:
        gray = px[..., 0]
    small = _antialias_resize(gray, RESIZE)
    coeffs = _DCT @ small @ _DCT.T
    low = coeffs[:HASH_SIZE, :HASH_SIZE]
    return (low > np.median(low)).flatten()


def _to_int64(bits: np.ndarray) -> int:
    value = 0
    for b in bits:
        value = (value << 1) | int(bool(b))
    return value - (1 << 64) if value >= (1 << 63) else value


_FP_TYPE = StructType([StructField("fingerprint", LongType()), StructField("fingerprint8", IntegerType())])


@pandas_udf(_FP_TYPE)
def _phash_udf(img: pd.DataFrame) -> pd.DataFrame:
    fps, folds = [], []
    for h, w, c, data in zip(img["height"], img["width"], img["nChannels"], img["data"]):
        bits = phash_bits(h, w, c, data)
        if bits is None:
            fps.append(None)
            folds.append(None)
        else:
            fps.append(_to_int64(bits))
            folds.append(int(sum(1 << (i % 8) for i, v in enumerate(bits) if v)))
    return pd.DataFrame({"fingerprint": pd.array(fps, dtype="Int64"),
                         "fingerprint8": pd.array(folds, dtype="Int32")})


def image_fingerprints(images: DataFrame) -> DataFrame:
    """(origin, fingerprint, fingerprint8) per image row."""
    fp = _phash_udf(F.col("image"))
    return images.select("origin", fp.alias("_fp")).select(
        "origin", F.col("_fp.fingerprint").alias("fingerprint"),
        F.col("_fp.fingerprint8").alias("fingerprint8"))
