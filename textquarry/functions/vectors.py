"""Text form of embedding vectors: `[v,...]` with eight decimals."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCALE = 100_000_000


#: Below it a double's whole part is a long.
_LONG = 9.0e18


def _eight_decimals(x: Column) -> Column:
    """The exact value, rounded to eight decimals, ties to even; beyond longs as Java formats it."""
    value = x.cast("double")
    size = F.abs(value)
    whole = F.floor(size).cast("double")
    part = size - whole  # exact, as is splitting it into halves of 26 bits and multiplying these by 10^8
    scaled = part * F.lit(float(_SCALE))
    wide = part * F.lit(float(2**27 + 1))
    high = wide - (wide - part)
    error = (high * F.lit(float(_SCALE)) - scaled) + (part - high) * F.lit(float(_SCALE))
    # The product's own rounding decides where it seems to lie half-way.
    below = F.floor(scaled).cast("double")
    half = scaled - below == 0.5
    n = F.when(half & (error > 0), below + 1).when(half & (error < 0), below).otherwise(F.rint(scaled)).cast("bigint")
    carry = F.when(n == _SCALE, 1).otherwise(0)
    exact = F.concat(
        F.when(F.startswith(value.cast("string"), F.lit("-")), "-").otherwise(""),
        (whole.cast("bigint") + carry).cast("string"),
        F.lit("."),
        F.lpad((n % _SCALE).cast("string"), 8, "0"),
    )
    return F.when(size < _LONG, exact).otherwise(F.format_string("%.8f", value))


def format_vector(embedding: Column) -> Column:
    """Text of an array of floats or doubles, each taken as it is."""
    values = F.transform(embedding, _eight_decimals)
    return F.concat(F.lit("["), F.array_join(values, ","), F.lit("]"))


def parse_vector(text: Column) -> Column:
    return F.from_json(F.trim(text), "array<double>")
