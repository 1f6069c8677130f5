"""Text building blocks: the two kinds of concatenation, keys and address lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from zilverspoor.functions.dates import format_date


def concat_skip_null(*parts: Column) -> Column:
    """Concatenation that leaves NULL parts out (a database's CONCAT function)."""
    return F.concat_ws("", *[part.cast("string") for part in parts])


def concat_propagate(*parts: Column) -> Column:
    """Concatenation that is NULL when any part is NULL (the ``||`` operator)."""
    return F.concat(*[part.cast("string") for part in parts])


def right_chars(value: Column, n: int) -> Column:
    """The last ``n`` characters of the text form."""
    return F.right(value.cast("string"), F.lit(n))


def format_bsn(value: Column) -> Column:
    """Nine digits, zero-padded on the left; NULL gives nine zeros."""
    return right_chars(concat_skip_null(F.lit("0" * 9), value), 9)


def zero_pad(value: Column, width: int) -> Column:
    """Left-pad with zeros; longer text is cut to ``width``."""
    return F.lpad(value.cast("string"), width, "0")


def suffixed_key(value: Column, suffix: str) -> Column:
    """Key with its source register behind it, NULL for a NULL key."""
    return concat_propagate(value, F.lit(suffix))


def pair_key(left: Column, right: Column, day: Column) -> Column:
    """One key for a couple, the same from either partner's side."""
    return concat_skip_null(
        F.greatest(left, right),
        F.lit("-"),
        F.least(left, right),
        F.lit("-"),
        F.coalesce(format_date(day), F.lit("x")),
    )


def address_line(
    street: Column,
    number: Column,
    letter: Column,
    addition: Column,
    marker: Column,
    postcode_digits: Column,
    postcode_letters: Column,
    town: Column,
    clean: bool = False,
) -> Column:
    """One-line address.

    The separator in front of an absent part stays by default, as in a database
    whose CONCAT skips NULLs; ``clean=True`` drops it together with the part.
    """

    def led(separator: str, part: Column) -> Column:
        if clean:
            return F.concat(F.lit(separator), part.cast("string"))
        return concat_skip_null(F.lit(separator), part)

    return concat_skip_null(
        street,
        led(" ", number),
        led(" ", letter),
        led(" ", addition),
        led(" ", marker),
        led(" ", postcode_digits),
        postcode_letters,
        led(",", town),
    )


def code_label(code: Column, labels: Mapping[object, str]) -> Column:
    """Decode a short code list in place; unlisted codes are NULL."""
    result = F.lit(None).cast("string")
    for key, label in labels.items():
        result = F.when(code == F.lit(key), F.lit(label)).otherwise(result)
    return result


def strip_nul(value: Column) -> Column:
    """Remove NUL characters, which several databases refuse in text."""
    return F.replace(value, F.lit("\x00"), F.lit(""))
