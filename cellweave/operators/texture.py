"""Texture, focal kernels, terrain and spectral indices over long-form rasters."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def block_entropy(pixels: DataFrame, factor: int, nodata: int | None, value: str = "value") -> DataFrame:
    """Shannon entropy (bits) of the classes in each block; null if a block has no data."""
    block = [F.floor(F.col("row") / factor).cast("long").alias("row"), F.floor(F.col("col") / factor).cast("long").alias("col")]
    has = F.col(value).isNotNull() & (F.col(value) != nodata if nodata is not None else F.lit(True))
    counts = pixels.groupBy(*block, F.when(has, F.col(value)).alias("c")).agg(F.count("*").alias("n"))
    n = F.when(F.col("c").isNotNull(), F.col("n"))
    # H = log2 N - sum(n log2 n) / N: one pass over the counts
    return counts.groupBy("row", "col").agg((F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)).alias("entropy"))


def glcm_homogeneity(pixels: DataFrame, factor: int, value: str = "value") -> DataFrame:
    """Homogeneity of the grey-level co-occurrence matrix of each block: distance 1, to the east, symmetric, normed."""
    b = lambda c: F.floor(F.col(c) / factor).cast("long")
    left = pixels.select("row", "col", F.col(value).alias("i"))
    right = pixels.select("row", (F.col("col") - 1).alias("col"), F.col(value).alias("j"))
    pairs = left.join(right, ["row", "col"]).where((b("col") == F.floor((F.col("col") + 1) / factor)))
    d = F.col("i") - F.col("j")
    return pairs.groupBy(b("row").alias("row"), b("col").alias("col")).agg(F.avg(F.lit(1.0) / (d * d + 1.0)).alias("homogeneity"))


def sobel_kernel(size: int = 3) -> np.ndarray:
    """Horizontal derivative: binomial smoothing across, binomial difference along, scaled by 2 ** -(2 size - 3)."""
    smooth = np.array([math.comb(size - 1, i) for i in range(size)], float)
    base = np.array([math.comb(size - 3, i) for i in range(size - 2)], float) if size > 2 else np.ones(1)
    return np.outer(smooth, np.convolve(base, [-1, 0, 1])) * 2.0 ** -(2 * size - 3)


def log_kernel(size: int = 5, sigma: float | None = None) -> np.ndarray:
    """Laplacian of Gaussian with zero sum; by default a sixth of the size is one sigma."""
    s = sigma or size / 6
    half = (size - 1) / 2
    y, x = np.mgrid[-half : half + 1, -half : half + 1]
    r2 = (x * x + y * y) / (2 * s * s)
    k = -(1 - r2) * np.exp(-r2) / (math.pi * s**4)
    return k - k.mean()


def savitzky_golay(size: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """First derivatives (along columns, along rows) of a quadratic surface fitted to a window."""
    half = size // 2
    y, x = np.mgrid[-half : half + 1, -half : half + 1]
    design = np.stack([np.ones(size * size), x.ravel(), y.ravel(), x.ravel() ** 2, x.ravel() * y.ravel(), y.ravel() ** 2], 1)
    solve = np.linalg.pinv(design)
    return solve[1].reshape(size, size), solve[2].reshape(size, size)


def convolve(pixels: DataFrame, kernels: dict[str, np.ndarray], value: str = "value", whole: bool = True) -> DataFrame:
    """Correlate with one or more kernels of one shape: (row, col, a column for each).

    Each pixel is sent to the places it has weight in, and one aggregation adds them up. ``whole``: only places
    whose window is complete.
    """
    first = next(iter(kernels.values()))
    h, w = first.shape
    offsets = F.array(*[F.struct(F.lit(i - h // 2).alias("dr"), F.lit(j - w // 2).alias("dc"), *[F.lit(float(k[i, j])).alias(n) for n, k in kernels.items()]) for i in range(h) for j in range(w)])
    spread = pixels.select("row", "col", F.col(value).cast("double").alias("v_"), F.explode(offsets).alias("o"))
    sums = spread.groupBy((F.col("row") - F.col("o.dr")).alias("row"), (F.col("col") - F.col("o.dc")).alias("col")).agg(F.count("v_").alias("n_"), *[F.sum(F.col("v_") * F.col(f"o.{n}")).alias(n) for n in kernels])
    return (sums.where(F.col("n_") == h * w) if whole else sums.join(pixels.select("row", "col"), ["row", "col"], "left_semi")).drop("n_")


def focal_sd(pixels: DataFrame, size: int = 3, value: str = "value") -> DataFrame:
    """Population standard deviation in a moving window."""
    both = pixels.select("row", "col", F.col(value).cast("double").alias("v"))
    one = np.ones((size, size)) / size**2
    mean, square = convolve(both, {"m": one}, "v"), convolve(both.withColumn("v", F.col("v") * F.col("v")), {"q": one}, "v")
    return mean.join(square, ["row", "col"]).select("row", "col", F.sqrt(F.greatest(F.col("q") - F.col("m") * F.col("m"), F.lit(0.0))).alias("sd"))


def terrain(pixels: DataFrame, cell: float, size: int = 7, value: str = "value") -> DataFrame:
    """Slope (degrees), northness and eastness from a fitted surface; rows run south."""
    dx, dy = savitzky_golay(size)
    d = convolve(pixels, {"gx": dx / cell, "gy": -dy / cell}, value)
    steep = F.sqrt(F.col("gx") * F.col("gx") + F.col("gy") * F.col("gy"))
    return d.select("row", "col", F.degrees(F.atan(steep)).alias("slope"), F.when(steep > 0, -F.col("gy") / steep).otherwise(0.0).alias("northness"), F.when(steep > 0, -F.col("gx") / steep).otherwise(0.0).alias("eastness"))


def ruggedness(pixels: DataFrame, by: list[Column], value: str = "value") -> DataFrame:
    """sqrt(mean of squares - square of the mean) in each group."""
    return pixels.groupBy(*by).agg(F.stddev_pop(value).alias("ruggedness"))


def cloud_free(scene: Column, value: Column) -> Column:
    """Values of vegetation, bare ground and water; null under any other scene class."""
    return F.when(scene.isin(4, 5, 6), value)


def bright_enough(value: Column, least: float = 0.01) -> Column:
    return F.when(value >= least, value)


def spectral_indices(b: dict[str, Column]) -> dict[str, Column]:
    """Published vegetation, pigment and water indices; bands by name (blue ... swir2), a zero divisor gives null."""
    def ratio(a: Column, c: Column) -> Column:
        return a / F.nullif(c, F.lit(0.0))

    blue, green, red, re1, re2, re3, nir, swir1, swir2 = (b[n] for n in ("blue", "green", "red", "re1", "re2", "re3", "nir", "swir1", "swir2"))
    inv = lambda v: ratio(F.lit(1.0), v)
    nd = lambda x, y: ratio(x - y, x + y)
    ndvi = nd(nir, red)
    return {
        "ndvi": ndvi,
        "evi": ratio((nir - red) * 2.5, nir + red * 6.0 - blue * 7.5 + 1.0),
        "msavi": (nir * 2.0 + 1.0 - F.sqrt(F.greatest((nir * 2.0 + 1.0) * (nir * 2.0 + 1.0) - (nir - red) * 8.0, F.lit(0.0)))) / 2.0,
        "ndre": nd(nir, re1),
        "reip": ratio((red + re3) / 2.0 - re1, re2 - re1) * 40.0 + 700.0,
        "ari": inv(green) - inv(re1),
        "cri": inv(blue) - inv(green),
        "mari": (inv(green) - inv(re1)) * nir,
        "mcri": (inv(blue) - inv(re1)) * nir,
        "ndwi": nd(green, nir),
        "ndmi": nd(nir, swir1),
        "nbr": nd(nir, swir2),
        "fpar": F.least(F.greatest(ndvi * 1.24 - 0.168, F.lit(0.0)), F.lit(1.0)),
        "ndli": ratio(F.log(inv(swir1)) - F.log(inv(swir2)), F.log(inv(swir1)) + F.log(inv(swir2))),
    }
