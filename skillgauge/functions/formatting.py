"""Cell texts and colours of the leaderboard table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour of the best cell (R, G, B) fading to white, decimals per target.
BEST_RGB = (99, 190, 123)
ET_DECIMALS = 4
OTHER_DECIMALS = 2


def significant(col: Column, digits: int) -> Column:
    """Text with ``digits`` significant figures, like ``%.{digits}g``: plain notation for
    exponents from -5 (exclusive) to ``digits``, trailing zeros removed. NULL stays NULL; ``nan``,
    ``inf`` and ``-inf`` are spelled out."""
    # The scientific text carries the exponent after rounding to the wanted digits.
    sci = F.format_string(f"%.{digits - 1}e", col)
    exponent = F.regexp_extract(sci, r"e([+-]\d+)$", 1).try_cast("int")
    mantissa = F.regexp_replace(F.regexp_extract(sci, r"^(.*)e", 1), r"(\.\d*?)0+$", "$1")
    mantissa = F.regexp_replace(mantissa, r"\.$", "")
    plain = F.lit(None).cast("string")
    for e in range(-4, digits):
        decimals = max(digits - 1 - e, 0)
        plain = F.coalesce(plain, F.when(exponent == e, F.format_string(f"%.{decimals}f", col)))
    plain = F.when(plain.contains("."), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)
    scientific = F.concat(
        mantissa,
        F.when(exponent < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(exponent).cast("string"), F.greatest(F.lit(2), F.length(F.abs(exponent).cast("string"))), F.lit("0")),
    )
    return (
        F.when(col.isNull(), F.lit(None).cast("string")).when(F.isnan(col), "nan")
        .when(col == float("inf"), "inf").when(col == float("-inf"), "-inf").when(col == 0, "0")
        .otherwise(F.coalesce(plain, scientific))
    )


def fixed(col: Column, decimals: int) -> Column:
    """Fixed decimals, ``-`` when missing."""
    return F.coalesce(F.when(col.isNotNull(), F.format_string(f"%.{decimals}f", col)), F.lit("-"))


def cell_text(value: Column, target: Column) -> Column:
    """Four decimals for ET (small values), two for the other targets."""
    return F.when(target == "ET", fixed(value, ET_DECIMALS)).otherwise(fixed(value, OTHER_DECIMALS))


def closeness(value: Column, best: Column, reach: float = 0.2, lower_is_better: bool = True) -> Column:
    """1 at the best value, 0 at ``reach`` (relative) away from it, linear between; NULL if missing."""
    if lower_is_better:
        limit = best * (1 + reach)
        return (
            F.when(value <= best, 1.0)
            .when(value >= limit, 0.0)
            .when(value.isNotNull() & best.isNotNull(), (limit - value) / F.nullif(limit - best, F.lit(0.0)))
        )
    limit = best * (1 - reach)
    return (
        F.when(value >= best, 1.0)
        .when(value <= limit, 0.0)
        .when(value.isNotNull() & best.isNotNull(), (value - limit) / F.nullif(best - limit, F.lit(0.0)))
    )


def colour(share: Column) -> Column:
    """Hex colour from white (0) to the best colour (1), channels truncated; white when missing."""
    channel = lambda full: (F.lit(255) - share * (255 - full)).cast("int")
    red, green, blue = BEST_RGB
    return F.coalesce(
        F.when(share.isNotNull(), F.format_string("%02X%02X%02X", channel(red), channel(green), channel(blue))),
        F.lit("FFFFFF"),
    )
