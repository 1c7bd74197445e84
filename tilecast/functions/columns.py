"""Column helpers: feature names, reproducible random numbers, output values and paths."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Seasons, bands per image, and the statistics taken from each band.
SEASONS = ("GS", "OS")
BANDS = (1, 2, 3, 4)
KINDS = ("raw", "avg", "std")

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"

#: Largest rate drawn from one random number; larger rates add up several draws.
MAX_RATE_PER_DRAW = 8.0


def feature_names(seasons: Sequence[str] = SEASONS, bands: Sequence[int] = BANDS) -> list[str]:
    return [f"{s}_{kind}_{b}" for s in seasons for b in bands for kind in KINDS]


def band_columns(bands: Sequence[int] = BANDS) -> list[str]:
    return [f"b{b}" for b in bands]


def uniform(seed: int | str | Column, *keys: str | Column) -> Column:
    """A number in [0, 1) that depends only on ``seed`` and the row's key values.

    Unlike ``rand(seed)`` it does not change with partitioning or when a lost task reruns.
    """
    parts = [seed if isinstance(seed, Column) else F.lit(str(seed))]
    parts += [F.col(k) if isinstance(k, str) else k for k in keys]
    text = F.concat_ws("_", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def poisson_steps(rate: float) -> list[float]:
    """Values of u at which the inverse Poisson distribution steps up by one."""
    steps, term, total, k = [], math.exp(-rate), 0.0, 0
    while True:
        total += term
        if 1.0 - total < 2.0**-33 and k > rate:
            return steps
        steps.append(total)
        k += 1
        term *= rate / k


def poisson_count(u: str, rate: float) -> Column:
    """How often a row is drawn at ``rate`` with replacement, given the column ``u`` of numbers.

    ``u`` holds arrays of independent numbers in [0, 1): one for each of :func:`draws_for` draws
    and each copy of the row. Their counts add up, as a sum of Poisson counts is again Poisson.
    """
    return F.aggregate(
        u, F.lit(0), lambda total, x: total + steps_passed(x, rate / draws_for(rate))
    )


def steps_passed(u: Column, rate: float) -> Column:
    """Inverse Poisson distribution at a single number ``u``."""
    return reduce(lambda a, b: a + b, [(u >= F.lit(s)).cast("int") for s in poisson_steps(rate)])


def draws_for(rate: float) -> int:
    return max(1, math.ceil(rate / MAX_RATE_PER_DRAW))


def uniforms(n: Column, seed: int | str, *keys: str | Column) -> Column:
    """An array of ``n`` independent numbers; the first is ``uniform(seed, *keys)``."""
    first = F.array(uniform(seed, *keys))
    more = F.transform(
        F.sequence(F.lit(2), n.cast("int")),
        lambda i: uniform(F.concat_ws("_", F.lit(str(seed)), i.cast("string")), *keys),
    )
    return F.when(n > 1, F.concat(first, more)).otherwise(first)


#: Means up to this are drawn by inversion, larger ones by transformed rejection.
INVERSION_MEAN = 10.0

#: Rejection rounds; each is accepted with a chance of over 0.7.
ROUNDS = 40


def _log_factorial(k: Column) -> Column:
    """Logarithm of k! for k >= 0, by Stirling's series at k + 10."""
    z = k + 11.0
    series = (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * F.pow(z, F.lit(5.0)))
    return series - reduce(lambda a, b: a + b, [F.log(k + float(i)) for i in range(1, 11)])


def poisson_draw(mean: Column, seed: int | str, *keys: str | Column) -> Column:
    """A Poisson count of any mean, from the row's keys alone, at a cost that does not grow with it.

    Small means are inverted from one number. Large ones use Hörmann's transformed rejection
    with a pair of numbers a round, which is exact; a row that 40 rounds reject (a chance below
    1e-20) gets the rounded mean.
    """
    # No number (a multiple of 2 ** -32 below 1) passes the sum of more steps than these.
    steps = F.least(F.ceil(3 * mean) + 14, F.lit(80)).cast("int")
    small = F.aggregate(
        F.sequence(F.lit(1), steps),
        # The number is hashed once and handed on from step to step.
        F.struct(
            F.exp(-mean).alias("term"), F.exp(-mean).alias("total"), F.lit(0).cast("bigint").alias("n"),
            uniform(seed, *keys).alias("u"),
        ),
        lambda a, i: F.when(a["u"] < a["total"], a).otherwise(F.struct(
            (a["term"] * mean / i).alias("term"),
            (a["total"] + a["term"] * mean / i).alias("total"),
            (a["n"] + 1).alias("n"),
            a["u"].alias("u"),
        )),
        lambda a: a["n"],
    )
    b = 0.931 + 2.53 * F.sqrt(mean)
    a = -0.059 + 0.02483 * b
    inverse_alpha, edge = 1.1239 + 1.1328 / (b - 3.4), 0.9277 - 3.6224 / (b - 2.0)

    def attempt(i: Column) -> Column:
        u = uniform(F.concat_ws("_", F.lit(f"{seed}u"), i), *keys) - 0.5
        v = F.greatest(uniform(F.concat_ws("_", F.lit(f"{seed}v"), i), *keys), F.lit(2.0**-34))
        us = F.greatest(0.5 - F.abs(u), F.lit(2.0**-34))
        k = F.floor((2 * a / us + b) * u + mean + 0.43)
        log_ratio = -mean + k * F.log(mean) - _log_factorial(F.greatest(k, F.lit(0)).cast("double"))
        good = ((us >= 0.07) & (v <= edge)) | (
            (k >= 0) & ~((us < 0.013) & (v > us))
            & (F.log(v) + F.log(inverse_alpha) - F.log(a / (us * us) + b) <= log_ratio)
        )
        return F.when(good, k.cast("bigint"))

    large = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        F.lit(None).cast("bigint"),
        lambda found, i: F.when(found.isNotNull(), found).otherwise(attempt(i)),
    )
    return F.when(mean < INVERSION_MEAN, small).otherwise(F.coalesce(large, F.round(mean).cast("bigint")))


def scale_to_int8(value: str | Column, factor: float = 100.0) -> Column:
    """``value`` times ``factor``, cut off to a signed byte (NULL if it does not fit)."""
    value = F.col(value) if isinstance(value, str) else value
    return (value * F.lit(factor)).try_cast("tinyint")


def validity_mask(bands: Sequence[str]) -> Column:
    """255 where every band has a value, else 0."""
    return F.when(
        F.forall(F.array(*[F.col(b).isNotNull() for b in bands]), lambda ok: ok), F.lit(255)
    ).otherwise(F.lit(0)).cast("smallint")


def mask_path(prefix: str, name: str = "name", col: str = "col", row: str = "row") -> Column:
    """Location of a site's label image."""
    return F.format_string("%s/%s_%s_%s.tif", F.lit(prefix), F.col(name), F.col(col), F.col(row))


def output_path(pattern: str, *values: str | Column) -> Column:
    """Fill the ``{}`` tokens of ``pattern`` with ``values`` in order (extra values are unused)."""
    tokens = pattern.count("{}")
    columns = [F.col(v) if isinstance(v, str) else v for v in values][:tokens]
    return F.format_string(
        pattern.replace("%", "%%").replace("{}", "%s"), *[c.cast("string") for c in columns]
    )
