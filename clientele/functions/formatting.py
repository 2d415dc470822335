"""String forms used at the export edge (metrics stay typed until then)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_date(ts: Column) -> Column:
    """``yyyy-MM-dd`` text of a datetime (the date part only)."""
    return F.date_format(ts, "yyyy-MM-dd")


def edge_text(value: Column) -> Column:
    """Text of a value, with ``''`` for NULL: missing fields stay present as empty."""
    return F.coalesce(value.cast("string"), F.lit(""))


def scientific_text(x: Column) -> Column:
    """Shortest round-trip scientific notation of a double: ``5E-01``, ``1E+00``.

    Matches the format the consumer of the payload was fed (one mantissa
    digit, optional fraction with no trailing zeros, ``E``, sign, at least
    two exponent digits).  Built from Spark's own shortest decimal text of the
    double (``cast(x as string)``, always with a decimal point, optionally
    with ``E<exp>``), re-arranged with a few regular expressions so it stays
    in whole-stage codegen.  NULL stays NULL.

    Exact wherever the JVM's double-to-text is shortest: always on Java 19+;
    on Java 17 every value in [0, 1] but subnormals (so every order ratio)
    matches, while some magnitudes above 1e16 get one digit too many.
    """
    text = x.cast("string")
    mantissa = F.regexp_extract(text, r"^-?([0-9]+\.[0-9]+)", 1)
    given_exp = F.coalesce(F.regexp_extract(text, r"E(-?[0-9]+)$", 1).try_cast("int"), F.lit(0))
    int_digits = F.substring_index(mantissa, ".", 1)
    digits = F.regexp_replace(mantissa, r"\.", "")
    significant = F.regexp_extract(digits, r"^0*([0-9]*?)0*$", 1)
    leading_zeros = F.length(F.regexp_extract(digits, r"^(0*)", 1))
    exponent = given_exp + F.length(int_digits) - leading_zeros - F.lit(1)
    pointed = F.regexp_replace(significant, r"^([0-9])([0-9]+)$", "$1.$2")
    sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return (
        F.when(x.isNull(), F.lit(None).cast("string"))
        .when(F.isnan(x), F.lit("NaN"))
        .when(x == F.lit(float("inf")), F.lit("+Inf"))
        .when(x == F.lit(float("-inf")), F.lit("-Inf"))
        .when(significant == "", F.concat(sign, F.lit("0E+00")))
        .otherwise(F.concat(sign, pointed, F.lit("E"), F.format_string("%+03d", exponent)))
    )
