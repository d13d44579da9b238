"""Telephone cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from hemline.functions.lookups import DIAL_CODES

# Digits outside the decimal class that still count as digits: super- and
# subscripts, circled, bracketed, dotted and dingbat numerals.
_ODD_DIGITS = (
    "²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼"
    "⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒"
)


def clean_phone(phone: Column) -> Column:
    """Drop brackets, an ``x`` extension, dots, hyphens and white space."""
    out = phone
    # fixed values: what is deleted, in this order
    for noise in (r"[()\[\]{}]", r"x\d*", r"[.\-]", r"\s+"):
        out = F.regexp_replace(out, noise, "")
    return F.trim(out)


def dial_prefix(country: Column) -> Column:
    """``+`` and the country's code; empty text for any other country."""
    out = F.lit("")
    for name, code in DIAL_CODES.items():
        out = F.when(country == name, F.lit("+" + code)).otherwise(out)
    return out


def add_dial_code(phone: Column, country: Column) -> Column:
    """International form of a cleaned number.

    A leading ``+`` is kept. ``0`` before one of the known codes becomes ``+``
    whatever the country says. All others get the country's prefix in place of
    their trunk digits.
    """
    code_after_zero = "^0(" + "|".join(DIAL_CODES.values()) + ")"
    return (
        F.when(phone.startswith("+"), phone)
        .when(phone.rlike(code_after_zero), F.regexp_replace(phone, "^0", "+"))
        .otherwise(
            F.concat(
                dial_prefix(country),
                F.regexp_replace(phone, "^(1|01|001|0{1,2})", ""),
            )
        )
    )


def phone_shape(phone: Column) -> Column:
    """``N`` per digit, ``L`` per letter; the text ``NULL`` for no number.

    Letters go first, or the ``N`` of a digit would count as a letter.
    """
    letters = F.regexp_replace(phone, r"\p{L}", "L")
    digits = F.regexp_replace(letters, r"[\p{Nd}" + _ODD_DIGITS + "]", "N")
    return F.when(F.length(phone) > 0, digits).otherwise(F.lit("NULL"))
