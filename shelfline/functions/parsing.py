"""Turning raw text columns into values. Nothing here raises: what cannot be read is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: blank characters a trim removes, and what counts as a number or a flag ---
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) \
    + "\u2028\u2029\u202f\u205f\u3000"
INFINITE = [sign + word for sign in ("", "+", "-") for word in ("inf", "infinity")]
TRUE_TEXT, FALSE_TEXT = ["1", "true"], ["0", "false"]
DATE_FORMAT = "yyyy-M-d"
ISBN_DIGITS = 13
# --- end of fixed values ---


def _last(text: Column) -> Column:
    return F.substring(text, -1, 1)


def _solid(first: Column) -> Column:
    """Whether the first character is certainly not blank: plain ASCII, or a letter up to U+167F."""
    code = F.ascii(first)
    return code.between(0x21, 0x7E) | code.between(0xA1, 0x167F)


def trimmed(text: Column) -> Column:
    """Without blanks at either end. Text that begins and ends in a visible character, as nearly all
    does, is passed on without searching the list of blanks."""
    return F.when(_solid(text) & _solid(_last(text)), text).otherwise(F.trim(text, F.lit(BLANKS)))


def number(text: Column) -> Column:
    """Decimal or exponent notation as a double.

    The cast alone would also take a type suffix (`1d`) or a hexadecimal; text that ends otherwise
    than a number does is not even tried.
    """
    digits = _last(text).between("0", "9") | (_last(text) == ".")
    plain = digits & ~text.contains("x") & ~text.contains("X")
    return F.when(plain | F.lower(text).isin(INFINITE), text.try_cast("double"))


def whole_number(text: Column) -> Column:
    """A 64-bit integer, read from its digits where it is written plainly; `1e3` and `7.0` count too, a
    fraction does not."""
    value = number(text)
    return F.coalesce(text.try_cast("bigint"), F.when(value % 1 == 0, value.try_cast("bigint")))


def flag(text: Column) -> Column:
    """1/0/true/false in any case as 1 or 0."""
    low = F.lower(trimmed(text))
    return F.when(low.isin(TRUE_TEXT), 1).when(low.isin(FALSE_TEXT), 0)


def number_flag(value: Column) -> Column:
    return F.when(value == 1, 1).when(value == 0, 0)


def day(text: Column) -> Column:
    """Year-month-day, padded or not."""
    return F.try_to_timestamp(text, F.lit(DATE_FORMAT)).cast("date")


def isbn13_ok(text: Column) -> Column:
    """Thirteen digits, whatever stands between them, whose weighted sum is a multiple of ten."""
    digits = F.regexp_replace(text, "[^0-9]", "")
    total = F.lit(0)
    for place in range(1, ISBN_DIGITS + 1):
        total = total + F.substring(digits, place, 1).cast("int") * (1 if place % 2 else 3)
    return F.when(F.length(digits) == ISBN_DIGITS, total % 10 == 0).otherwise(False)


def typed(text: Column, value: Column, kind: T.DataType) -> Column:
    """A parsed column in its table type: from the text where it reads exactly, else from the number."""
    name = kind.simpleString()
    if isinstance(kind, (T.ShortType, T.IntegerType, T.LongType)):
        return F.coalesce(text.try_cast(name), value.try_cast("bigint").try_cast(name))
    return F.coalesce(text.try_cast(name), value.try_cast(name))
