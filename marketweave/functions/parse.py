"""Values out of text: prices, counts, scores, dates, numbers, money.

All of it runs in the JVM and none of it can fail a task under ANSI mode: the text is
checked against a pattern first and cast with ``try_cast``.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, functions as F

from .text import WS, _col

# A float literal.  The sign of a NaN stays outside the group.
_NUMBER = r"(?:[+-](?=nan))?([+-]?(?:(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?)|nan)"
_INFINITE = r"(?i)inf"
_BLANK = r"[ \t\n\r\f\x0b]*"
_NUMBER_ONLY = rf"(?i)^{_BLANK}{_NUMBER}{_BLANK}\z"

# The number is the second of two tokens, or else the first one.
_TOKEN = rf"[^{WS}]+"
_PRICE = rf"(?i)^[{WS}]*(?:{_TOKEN}[{WS}]+(?={_TOKEN}[{WS}]*\z))?{_NUMBER}(?:(?:[{WS}]+{_TOKEN}){{2,}})?[{WS}]*\z"
_FIRST_OF_TWO = rf"^[{WS}]*({_TOKEN})[{WS}]+{_TOKEN}[{WS}]*\z"

# Every decimal digit outside ASCII and its value, from the Unicode database.
_FOREIGN = [(ch, unicodedata.decimal(ch)) for ch in map(chr, range(128, 0x110000)) if unicodedata.decimal(ch, None) is not None]
_FOREIGN_DIGITS = "".join(ch for ch, _ in _FOREIGN)
_ASCII_DIGITS = "".join(str(v) for _, v in _FOREIGN)


def ascii_digits(c: Column | str) -> Column:
    """Decimal digits of any script as 0-9."""
    c = _col(c)
    return F.when(c.rlike(r"[^\x00-\x7f]"), F.translate(c, _FOREIGN_DIGITS, _ASCII_DIGITS)).otherwise(c)


def coerce_numeric(c: Column | str) -> Column:
    """A column as double; text that is no number, and NaN, become null.

    ASCII digits only, blanks around them allowed; a literal too large for a double is not
    a number, the word for infinity is.
    """
    text = _col(c).cast("string")
    value = nan_to_null(F.regexp_extract(text, _NUMBER_ONLY, 1).try_cast("double"))
    return F.when((F.abs(value) < F.lit(float("inf"))) | text.rlike(_INFINITE), value)


def nan_to_null(c: Column | str) -> Column:
    return F.nanvl(_col(c), F.lit(None).cast("double"))


def parse_price(c: Column | str) -> Column:
    """``struct(price, currency)`` from the price text of a card.

    Two tokens are currency and price.  Otherwise the first token is the price and the
    currency is empty.  When the price is no number (thousands separators included) or
    there is no text, both are null.  Digits of any script count, also with ``_`` between.
    """
    c = _col(c)
    plain = F.when(c.contains("_"), F.regexp_replace(ascii_digits(c), r"(?<=[0-9])_(?=[0-9])", "")).otherwise(ascii_digits(c))
    price = F.regexp_extract(plain, _PRICE, 1).try_cast("double")
    currency = F.when(price.isNotNull(), F.regexp_extract(c, _FIRST_OF_TWO, 1))
    return F.struct(price.alias("price"), currency.alias("currency"))


def parse_reviews(c: Column | str) -> Column:
    """First run of digits and commas: ``"1,234 ratings"`` -> 1234.0; without digits null."""
    run = F.regexp_extract(ascii_digits(c), r"([0-9,]+)", 1)
    return F.replace(run, F.lit(","), F.lit("")).try_cast("double")


def parse_score(c: Column | str) -> Column:
    """First run of digits and dots: ``"4.5 out of 5"`` -> 4.5; null if that is no number."""
    return F.regexp_extract(ascii_digits(c), r"([0-9.]+)", 1).try_cast("double")


# The three accepted layouts, tried in this order; one- or two-digit
# month and day (a one-digit day may have a space before it), four-digit year from 0001 on.
_DAY = "(?:[0-9]{1,2}| [1-9])"
_YMD_DASH = rf"^(?!0000)[0-9]{{4}}-[0-9]{{1,2}}-{_DAY}\z"
_DMY_SLASH = rf"^({_DAY})/([0-9]{{1,2}})/((?!0000)[0-9]{{4}})\z"
_YMD_SLASH = rf"^(?!0000)[0-9]{{4}}/[0-9]{{1,2}}/{_DAY}\z"


def parse_date(c: Column | str) -> Column:
    """Text as a date in one of the three layouts, else null."""
    c = _col(c)
    iso = (
        F.when(c.rlike(_YMD_DASH), c)
        .when(c.rlike(_DMY_SLASH), F.regexp_replace(c, _DMY_SLASH, "$3-$2-$1"))
        .when(c.rlike(_YMD_SLASH), F.translate(c, "/", "-"))
    )
    return F.translate(iso, " ", "").try_cast("date")


def money(c: Column | str) -> Column:
    """``decimal(10,2)``; half cents round away from zero on the shortest decimal text.

    NaN has no decimal form and becomes null; a value too wide for the column fails the
    job, as the target table would refuse it, whatever the session's ANSI mode is.
    """
    number = nan_to_null(_col(c).cast("double"))
    held = number.try_cast("decimal(10,2)")
    wide = F.raise_error(F.concat(F.lit("too wide for decimal(10,2): "), number.cast("string"))).cast("decimal(10,2)")
    return F.when(number.isNotNull() & held.isNull(), wide).otherwise(held)
