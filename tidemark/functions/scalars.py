"""Scalar helpers on columns: tolerant parsing, defaults, rounding, list text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .frames import EXACT_LIMIT, TWO_27_PLUS_1

# The text of a decimal number, digits may be grouped with "_".
NUMBER_TEXT = (
    r"^\s*[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
)
INFINITY_TEXT = r"(?i)^\s*[+-]?inf(inity)?\s*$"
UNUSUAL = r"[^0-9eE+. -]"
# Texts that stand for a missing number.
MISSING_TEXTS = ("", "NA", "N/A", "null", "None")

VALUE_PLACES = 2


def nan_to_null(x: Column) -> Column:
    """Spark orders NaN above every number, so it must not reach a comparison."""
    return F.when(~F.isnan(x), x)


def tolerant_float(x: Column) -> Column:
    """Number from text, NULL if it is none. Never raises under ANSI mode.

    ``1_000`` is a number and ``1d`` is not, unlike in a plain cast. ``nan``
    gives NULL: a missing value must not pass as a number.
    """
    text = x.cast("string")
    is_number = text.rlike(NUMBER_TEXT) | text.rlike(INFINITY_TEXT)
    # Nearly all texts hold plain characters only and need no closer look.
    return F.when(~text.rlike(UNUSUAL), text.try_cast("double")).when(
        is_number, F.replace(F.trim(text), F.lit("_"), F.lit("")).try_cast("double")
    )


def float_or_missing(x: Column) -> Column:
    """Like ``tolerant_float``; also knows the usual texts for a missing number."""
    return F.when(~F.trim(x).isin(*MISSING_TEXTS), tolerant_float(x))


def default_if_empty(x: Column, default: Column) -> Column:
    return F.coalesce(F.nullif(x, F.lit("")), default)


def round_value(x: Column, places: int = VALUE_PLACES) -> Column:
    """Round the exact binary value to the nearest decimal, ties to even.

    The built-in functions round the shortest decimal text of a double instead
    and differ where that text is a tie: 2.675 is stored slightly below the tie,
    so it becomes 2.67 here. The product with the power of ten is taken as its
    double plus its exact error (a two-product), and the error decides where the
    double alone looks like a tie. For several columns of a large table use
    ``frames.round_columns``.
    """
    scale = F.lit(float(10**places))
    value = x.cast("double")
    product = value * scale
    high = value * TWO_27_PLUS_1 - (value * TWO_27_PLUS_1 - value)
    error = (high * scale - product) + (value - high) * scale
    whole = F.rint(product)
    rest = product - whole
    nearest = (
        F.when((rest == 0.5) & (error > 0), whole + 1)
        .when((rest == -0.5) & (error < 0), whole - 1)
        .otherwise(whole)
    )
    return F.when(F.abs(product) < EXACT_LIMIT, nearest / scale).otherwise(value)


def short_number(x: Column) -> Column:
    """Text of a number with two places, a last zero left out: 1.0, 1.5, 1.55."""
    return F.regexp_replace(F.format_string("%.2f", x), "0$", "")


def list_from_text(x: Column) -> Column:
    """``['a', 'b']`` (either quote) to an array; other text to a one-element array."""
    parsed = F.from_json(x, "array<string>")
    return F.when(F.ltrim(x).startswith("["), parsed).when(x.isNotNull(), F.array(x))


def any_contains(values: Column, *tokens: str) -> Column:
    """True if any element holds any of the tokens; NULL elements hold none."""

    def hit(v: Column) -> Column:
        found = F.lit(False)
        for token in tokens:
            found = found | F.coalesce(F.contains(v, F.lit(token)), F.lit(False))
        return found

    return F.coalesce(F.exists(values, hit), F.lit(False))


def query_values(url: Column, key: str) -> Column:
    """All values of a repeated key in the query string of a URL, in order, decoded.

    The query string is what stands between the first ``?`` and a ``#``, so a URL
    that is malformed elsewhere still tells its values. Without one: NULL.
    """
    query = F.when(F.contains(url, F.lit("?")), F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1))
    found = F.regexp_extract_all(query, F.lit(f"(?:^|&){key}=([^&]*)"), F.lit(1))
    return F.transform(found, lambda v: F.coalesce(F.try_url_decode(v), v))


def request_key_parts(key: Column) -> Column:
    """``source|facility|start|end`` to a struct; NULL unless there are four parts."""
    parts = F.split(key, r"\|")
    names = ("source", "facility_code", "date_start", "date_end")
    fields = F.struct(*(F.get(parts, F.lit(i)).alias(n) for i, n in enumerate(names)))
    return F.when(F.size(parts) == len(names), fields)
