"""Tenor text -> canonical tenor and delivery period.

Instead of a chain of regular expressions, the text is reduced once to its
*shape* (letters become ``A``, digits become ``9``); each accepted form is then
an equality on the shape plus a look at fixed positions, all inside generated
code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names in calendar order.
MONTHS = (
    "JANUARY",
    "FEBRUARY",
    "MARCH",
    "APRIL",
    "MAY",
    "JUNE",
    "JULY",
    "AUGUST",
    "SEPTEMBER",
    "OCTOBER",
    "NOVEMBER",
    "DECEMBER",
)
WHITESPACE = " \t\n\r\f\x0b"

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def _lookup(pairs: dict[str, str], key: Column) -> Column:
    entries = ", ".join(f"'{name}', '{value}'" for name, value in pairs.items())
    return F.element_at(F.expr(f"map({entries})"), key)


def _month_by_abbreviation(abbreviation: Column) -> Column:
    return _lookup({m[:3]: f"{i:02d}" for i, m in enumerate(MONTHS, 1)}, abbreviation)


def _month_by_name(name: Column) -> Column:
    return _lookup({m: f"{i:02d}" for i, m in enumerate(MONTHS, 1)}, name)


def _relative_steps(text: Column, letter: str) -> Column:
    """The n of ``M+n`` / ``Q+n``, or NULL when the text is not of that form."""
    tail = F.substring(text, 3, 64)
    all_digits = (F.length(tail) > 0) & (F.translate(tail, _DIGITS, "") == "")
    return F.when(F.startswith(text, F.lit(f"{letter}+")) & all_digits, tail.try_cast("bigint"))


def months_ahead(clock: Column, n: Column) -> Column:
    total = F.month(clock) - 1 + n
    year = F.year(clock) + F.floor(total / 12).cast("bigint")
    month = total % 12 + 1
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(month.cast("string"), 2, "0"))


def quarters_ahead(clock: Column, n: Column) -> Column:
    total = F.quarter(clock) - 1 + n
    year = F.year(clock) + F.floor(total / 4).cast("bigint")
    return F.concat(year.cast("string"), F.lit("-Q"), (total % 4 + 1).cast("string"))


def tenor_text(raw: Column) -> Column:
    return F.upper(stripped(raw))


def tenor_shape(text: Column) -> Column:
    return F.translate(text, _LETTERS + _DIGITS, "A" * 26 + "9" * 10)


def canonical_tenor(text: Column, shape: Column, clock: Column) -> Column:
    """Canonical tenor, or NULL when no accepted form matches.

    ``text`` and ``shape`` come from the two functions above; keep them as
    columns so that they are computed once. ``clock`` anchors the relative
    forms. The first form that matches decides.
    """
    year_first = F.substring(text, 1, 4)
    year_last = F.right(text, F.lit(4))
    two_digit_year = F.concat(F.lit("20"), F.right(text, F.lit(2)))
    prefix = F.substring(text, 1, 3)
    abbreviated = _month_by_abbreviation(prefix)

    # "<word><blank(s)>dddd"
    head = F.substring(text, F.lit(1), F.length(text) - 4)
    word = F.rtrim(head, F.lit(WHITESPACE))
    spaced_year = (
        (F.translate(year_last, _DIGITS, "9" * 10) == "9999")
        & (F.length(word) < F.length(head))
    )

    iso_month = F.lpad(F.substring(text, 6, 2), 2, "0")
    months = _relative_steps(text, "M")
    quarters = _relative_steps(text, "Q")
    quarter_digit = F.when(F.startswith(text, F.lit("Q")), F.substring(text, 2, 1)).otherwise(
        F.right(text, F.lit(1))
    )
    quarter_ok = quarter_digit.isin("1", "2", "3", "4")
    quarter_first = (
        F.startswith(shape, F.lit("A9"))
        & (F.length(text) == 7)
        & F.startswith(text, F.lit("Q"))
        & (F.instr(F.lit(WHITESPACE + "-"), F.substring(text, 3, 1)) > 0)
        & (F.translate(year_last, _DIGITS, "9" * 10) == "9999")
        & quarter_ok
    )
    quarter_last = (
        shape.isin("9999A9", "9999-A9")
        & (F.substring(text, -2, 1) == "Q")
        & quarter_ok
    )

    def tagged(year: Column, suffix: str) -> Column:
        return F.concat(year, F.lit(f"-{suffix}"))

    return (
        F.when(months.isNotNull(), months_ahead(clock, months))
        .when(quarters.isNotNull(), quarters_ahead(clock, quarters))
        .when(text.isin("SPOT", "D+1"), F.lit("spot"))
        .when(
            shape.isin("9999-9", "9999-99"),
            F.when(
                iso_month.between("01", "12"), F.concat(year_first, F.lit("-"), iso_month)
            ),
        )
        .when(
            (shape == "AAA99") & abbreviated.isNotNull(),
            F.concat(two_digit_year, F.lit("-"), abbreviated),
        )
        .when(
            (shape == "AAA-99") & abbreviated.isNotNull(),
            F.concat(two_digit_year, F.lit("-"), abbreviated),
        )
        .when(
            (shape == "AAA-9999") & abbreviated.isNotNull(),
            F.concat(year_last, F.lit("-"), abbreviated),
        )
        .when(
            spaced_year & _month_by_name(word).isNotNull(),
            F.concat(year_last, F.lit("-"), _month_by_name(word)),
        )
        .when(quarter_first, F.concat(year_last, F.lit("-Q"), quarter_digit))
        .when(quarter_last, F.concat(year_first, F.lit("-Q"), quarter_digit))
        .when(spaced_year & (word == "SUMMER"), tagged(year_last, "SUM"))
        .when((shape == "AAA99") & (prefix == "SUM"), tagged(two_digit_year, "SUM"))
        .when(spaced_year & (word == "WINTER"), tagged(year_last, "WIN"))
        .when((shape == "AAA99") & (prefix == "WIN"), tagged(two_digit_year, "WIN"))
        .when((shape == "AAA-9999") & (prefix == "CAL"), tagged(year_last, "CAL"))
        .when((shape == "AAA99") & (prefix == "CAL"), tagged(two_digit_year, "CAL"))
        .when(shape == "9999", tagged(text, "CAL"))
    )


def delivery_period(tenor: Column) -> Column:
    """Delivery period of a canonical tenor."""
    return (
        F.when(tenor == "spot", "spot")
        .when(F.endswith(tenor, F.lit("-CAL")), "annual")
        .when(F.endswith(tenor, F.lit("-SUM")) | F.endswith(tenor, F.lit("-WIN")), "seasonal")
        .when(F.substring(tenor, -2, 1) == "Q", "quarterly")
        .when(tenor.isNotNull(), "monthly")
    )


def delivery_start(tenor: Column) -> Column:
    """``YYYY-MM`` of the first delivery month; spot sorts before everything."""
    year = F.substring_index(tenor, "-", 1)
    quarter = F.right(tenor, F.lit(1)).try_cast("int")
    return (
        F.when(tenor == "spot", "0000-00")
        .when(F.endswith(tenor, F.lit("-CAL")), F.concat(year, F.lit("-01")))
        .when(F.endswith(tenor, F.lit("-SUM")), F.concat(year, F.lit("-04")))
        .when(F.endswith(tenor, F.lit("-WIN")), F.concat(year, F.lit("-10")))
        .when(
            F.substring(tenor, -2, 1) == "Q",
            F.concat(year, F.lit("-"), F.lpad((quarter * 3 - 2).cast("string"), 2, "0")),
        )
        .otherwise(tenor)
    )
