"""Array arithmetic on a single window of pixels, called inside Spark tasks.

Arrays are ``[bands, height, width]`` floats with NaN for nodata. Sums run over shifted
slices, so integer imagery gives exact sums.
"""

import hashlib

import numpy as np


def box_sum(a, size):
    """Sum over every ``size`` x ``size`` box that fits; the border is lost."""
    h, w = a.shape[-2] - size + 1, a.shape[-1] - size + 1
    across = sum(a[..., :, i : i + w] for i in range(size))
    return sum(across[..., i : i + h, :] for i in range(size))


def focal_mean(a, size):
    valid = ~np.isnan(a)
    n = box_sum(valid.astype(float), size)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, box_sum(np.where(valid, a, 0.0), size) / n, np.nan)


def focal_stddev(a, size):
    """Population standard deviation; values are centred first to keep squares small."""
    valid = ~np.isnan(a)
    n = box_sum(valid.astype(float), size)
    count = np.maximum(valid.sum(axis=(-2, -1), keepdims=True), 1)
    centre = np.round(np.where(valid, a, 0.0).sum(axis=(-2, -1), keepdims=True) / count)
    v = np.where(valid, a - centre, 0.0)
    s, q = box_sum(v, size), box_sum(v * v, size)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(n > 0, np.sqrt(np.maximum(n * q - s * s, 0.0)) / n, np.nan)


def slope(a, pixel_width, pixel_height):
    """Slope in degrees from the 3 x 3 weighted differences of Horn (1981)."""
    h, w = a.shape[-2] - 2, a.shape[-1] - 2

    def at(dy, dx):
        return a[..., dy : dy + h, dx : dx + w]

    gx = (at(0, 2) + 2 * at(1, 2) + at(2, 2)) - (at(0, 0) + 2 * at(1, 0) + at(2, 0))
    gy = (at(2, 0) + 2 * at(2, 1) + at(2, 2)) - (at(0, 0) + 2 * at(0, 1) + at(0, 2))
    return np.degrees(np.arctan(np.hypot(gx / (8 * pixel_width), gy / (8 * pixel_height))))


def erode(a, border):
    return a[..., border : a.shape[-2] - border, border : a.shape[-1] - border]


def axis_weights(positions, length, method):
    """Matrix that interpolates ``length`` source pixels at fractional ``positions``."""
    source = np.arange(length)
    if method == "nearest":
        return (np.floor(positions + 0.5)[:, None] == source).astype(float)
    if method == "bilinear":
        return np.maximum(0.0, 1.0 - np.abs(positions[:, None] - source))
    raise ValueError(f"unknown resampling method: {method}")


def resample(a, rows, cols):
    """Apply axis weights on both axes; nodata pixels are left out and weights rescaled."""
    valid = ~np.isnan(a)
    total = rows @ np.where(valid, a, 0.0) @ cols.T
    weight = rows @ valid.astype(float) @ cols.T
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(weight > 0, total / weight, np.nan)


def drawn_pixels(
    prefix: str, width: int, height: int, steps: list[float]
) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts of the pixels of a tile that a Poisson sample draws.

    The number of a pixel is ``uniform`` of the seed and cell in ``prefix``, its column and its row.
    """
    start = hashlib.md5(f"{prefix}_".encode())

    def first_bytes(text: str) -> bytes:
        whole = start.copy()
        whole.update(text.encode())
        return whole.digest()[:4]

    hashes = b"".join(first_bytes(f"{x}_{y}") for y in range(height) for x in range(width))
    counts = np.searchsorted(steps, np.frombuffer(hashes, ">u4") / 2.0**32, side="right").astype(np.int32)
    place = np.flatnonzero(counts).astype(np.int32)
    return place, counts[place]
