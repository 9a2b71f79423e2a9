"""Column functions that Spark has no built-in for."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Coefficients of the rational Chebyshev form of erfc (Numerical Recipes), highest power first.
ERFC = [0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223]


def erfc(z: Column) -> Column:
    """Complementary error function for z >= 0, relative error below 1.2e-7."""
    t = 1 / (1 + z / 2)
    poly = F.lit(ERFC[0])
    for c in ERFC[1:]:
        poly = poly * t + c
    return t * F.exp(-z * z + poly)


def format_4g(x: Column) -> Column:
    """Four significant digits, trailing zeros left out, as %.4g writes it; a tie of the shortest decimal form rounds up."""
    a = F.abs(x)
    e = F.when(a > 0, F.floor(F.log10(a))).otherwise(0)
    rounded = F.abs(F.format_string("%.3e", x).cast("double"))
    e = F.when(rounded > 0, F.floor(F.log10(rounded) + 1e-9)).otherwise(e)
    scientific = F.regexp_replace(F.regexp_replace(F.format_string("%.3e", x), r"\.?0+e", "e"), r"e([+-])(\d)$", "e$10$2")
    # plain notation: 3 - e decimals, trailing zeros cut
    plain = F.format_string("%.3f", x)
    for places in range(8):
        plain = F.when(e == 3 - places, F.format_string(f"%.{places}f", x)).otherwise(plain)
    plain = F.when(plain.contains("."), F.regexp_replace(plain, r"\.?0+$", "")).otherwise(plain)
    return F.when(x.isNull(), F.lit("nan")).when((e < -4) | (e >= 4), scientific).otherwise(plain)


def pretty_name(x: Column) -> Column:
    return F.initcap(F.translate(x, "_", " "))


def slug(name: Column) -> Column:
    """A model's name as a file name: safe characters and a digest of the whole."""
    safe = F.regexp_replace(name, r"[^A-Za-z0-9._-]+", "_")
    return F.concat(safe, F.lit("-"), F.substring(F.sha2(name, 256), 1, 12))


def base_model(name: Column) -> Column:
    return F.regexp_replace(name, "_hpo$", "")


def json_array(text: Column) -> Column:
    """A JSON list of texts; null if it isn't one, is empty or repeats itself."""
    parsed = F.from_json(text, "array<string>")
    return F.when((F.size(parsed) > 0) & (F.size(F.array_distinct(parsed)) == F.size(parsed)), parsed)
