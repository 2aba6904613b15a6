"""Pixel arrays: scaling, per-channel normalisation and resizing."""

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F

# Per-channel statistics, in red, green, blue order.
CHANNEL_MEAN = (0.485, 0.456, 0.406)
CHANNEL_STD = (0.229, 0.224, 0.225)


def normalize_planes(planes: Column, mean=CHANNEL_MEAN, std=CHANNEL_STD) -> Column:
    """``(x/255 - mean) / std`` over planar pixels (all of channel 0, then 1, ...)."""

    def scaled(m, s):
        return lambda x: (x / F.lit(255.0) - F.lit(m)) / F.lit(s)

    def every_channel(pixels):
        length = (F.size(pixels) / len(mean)).cast("int")
        return F.concat(
            *[
                F.transform(F.slice(pixels, length * c + 1, length), scaled(m, s))
                for c, (m, s) in enumerate(zip(mean, std))
            ]
        )

    # Bound to a lambda variable, the argument is evaluated once and not per use.
    return F.get(F.transform(F.array(planes), every_channel), F.lit(0))


def gray_planes(pixels: Column, channels: int = 3) -> Column:
    """One grey plane repeated for each colour channel."""
    return F.concat(*[pixels] * channels)


def _tap_weights(old: int, new: int) -> np.ndarray:
    """Triangle-filter weights, widened by the scale when shrinking."""
    scale = old / new
    width = max(scale, 1.0)
    centres = (np.arange(new) + 0.5) * scale
    taps = np.clip(1 - np.abs((np.arange(old) + 0.5) - centres[:, None]) / width, 0, None)
    return taps / taps.sum(axis=1, keepdims=True)


def _planes(height, width, channels, data) -> np.ndarray:
    """Interleaved grey, BGR or BGRA bytes to red, green and blue planes."""
    grid = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.stack([grid[..., 0]] * 3 if channels == 1 else [grid[..., c] for c in (2, 1, 0)])


def resize(image: Column, height: int, width: int, whole_pixels: bool = True) -> Column:
    """Spark ``image`` struct to RGB planes of ``height`` x ``width``, as ``array<double>``.

    No built-in resamples, so this one step is an Arrow-batched function. The
    session setting ``spark.sql.execution.arrow.maxBytesPerBatch`` bounds the
    bytes of pictures that a task holds at once.
    """

    @F.pandas_udf("array<double>")
    def resample(images: pd.DataFrame) -> pd.Series:
        out = []
        for row in images.itertuples(index=False):
            if row.data is None or row.height <= 0:
                out.append(None)
                continue
            planes = _planes(row.height, row.width, row.nChannels, row.data).astype(float)
            scaled = _tap_weights(row.height, height) @ planes @ _tap_weights(row.width, width).T
            out.append((np.rint(scaled) if whole_pixels else scaled).ravel())
        return pd.Series(out, dtype=object)

    return resample(image)
