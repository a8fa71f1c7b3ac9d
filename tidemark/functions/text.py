"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.numbers import half_even


def title_case(text: Column) -> Column:
    """Capitalise every run of letters: ``snapdragon 7s`` -> ``Snapdragon 7S``.

    ``initcap`` only looks at whitespace, so the text is cut into letter and
    non-letter runs and each run is capitalised on its own.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(0))
    return F.array_join(
        F.transform(
            runs,
            lambda run: F.concat(
                F.upper(F.substring(run, 1, 1)),
                F.lower(F.substring(run, F.lit(2), F.length(run))),
            ),
        ),
        "",
    )


def tidy_text(text: Column) -> Column:
    """Trim, then title-case; null stays null."""
    return title_case(F.trim(text))


def sentinel_to_null(text: Column, *sentinels: str) -> Column:
    """Words that stand for a missing value become null."""
    return F.when(text.isin(*sentinels), F.lit(None)).otherwise(text)


def char_count(text: Column, character: str) -> Column:
    """How often ``character`` occurs in the whole text."""
    return F.length(text) - F.length(F.replace(text, F.lit(character), F.lit("")))


def money_text(amount: Column) -> Column:
    """``Rs.1,234`` with thousands separators and no decimals."""
    return F.concat(F.lit("Rs."), F.format_number(amount, 0))


def whole_text(number: Column) -> Column:
    """``1,234``."""
    return F.format_number(number, 0)


def one_decimal_text(number: Column) -> Column:
    """``30.1``."""
    return F.format_string("%.1f", half_even(number, 1))


def percent_text(share: Column, digits: int = 1) -> Column:
    """``0.123`` -> ``12.3%``."""
    return F.format_string(f"%.{digits}f%%", half_even(share * 100, digits))
