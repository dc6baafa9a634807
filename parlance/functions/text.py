"""Text expressions: tokenising, templates, previews."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separator controls that also split words.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def words(text: Column, first: int | None = None) -> Column:
    """Lower-cased whitespace-separated words, without empty ones; only the ``first`` ones if a number is given."""
    # An empty word can stand before them and the unsplit rest after them.
    parts = F.split(F.lower(text), WHITESPACE, -1 if first is None else first + 2)
    found = F.filter(parts, lambda w: w != F.lit(""))
    return found if first is None else F.slice(found, 1, first)


def strip(text: Column) -> Column:
    """Remove white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def preview(text: Column, length: int = 100) -> Column:
    """The first characters followed by an ellipsis, as printed in sample listings."""
    return F.concat(F.substring(text, 1, length), F.lit("..."))


def extract_response(generated: Column, context: Column) -> Column:
    """What a generated text adds to its (lower-cased) prompt."""
    return strip(F.replace(generated, F.lower(context), F.lit("")))


def labelled_context(category: Column, sentiment: Column, outcome: Column, message: Column) -> Column:
    """The four conversation fields as one prompt; NULL if any of them is NULL."""
    return F.concat(
        F.lit("Category: "), category, F.lit(", Sentiment: "), sentiment,
        F.lit(", Outcome: "), outcome, F.lit(", Message: "), message,
    )


def two_decimals(value: Column) -> Column:
    """A non-negative double with two decimals, rounded by its exact binary value, ties to even.

    ``format_string`` rounds the shortest decimal text half up, which turns 0.125 into 0.13.
    Here ``200 * value`` is split exactly into a double and its rounding error; an odd
    integer is a tie unless the error says on which side of it the value lies.
    """
    doubled = value * F.lit(200.0)
    scaled = value * F.lit(134217729.0)
    high = scaled - (scaled - value)
    error = (high * F.lit(200.0) - doubled) + (value - high) * F.lit(200.0)
    near = F.pmod(doubled, F.lit(2.0)) == F.lit(1.0)
    cents = (
        F.when(near & (error > 0), (doubled + 1) / 2).when(near & (error < 0), (doubled - 1) / 2)
        .otherwise(F.bround(doubled / 2, 0)).cast("bigint")
    )
    return F.concat(
        F.floor(cents / 100).cast("string"), F.lit("."), F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0")
    )


def state_context(category: Column, satisfaction: Column) -> Column:
    """A logged state as a prompt, satisfaction with two decimals."""
    return F.concat(F.lit("Category: "), category, F.lit(", Satisfaction: "), two_decimals(satisfaction))


def fill_template(template: Column, product: Column, quality: Column) -> Column:
    """Replace the two named slots of a response template."""
    return F.replace(F.replace(template, F.lit("{product}"), product), F.lit("{quality}"), quality)
