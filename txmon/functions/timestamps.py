"""Parsing of timestamps written in many layouts.

Trying ``try_to_timestamp`` once per layout costs a Java exception for each one that does
not fit. Here the separator a text has in third or fifth place decides which layouts can
fit at all; the all-digit ones are rewritten to ISO order and read with a cast, which
fails without exceptions, and only month names, AM/PM and days of the year need a parser.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: the layouts read, besides Spark's own yyyy-MM-dd HH:mm:ss notation ---
#   dd-MM-yyyy, dd-MM-yyyy HH:mm, dd-MM-yyyy HH:mm:ss
#   MM/dd/yyyy, MM/dd/yyyy HH:mm:ss, MM/dd/yyyy hh:mm:ss a
#   dd/MM/yyyy, dd/MM/yyyy HH:mm:ss (where month-first is no date)
#   MMM dd yyyy HH:mm:ss, MMM-dd-yyyy HH:mm:ss
#   yyyy.MM.dd HH:mm:ss
#   yyyy/MM/dd HH:mm, yyyy/MM/dd HH:mm:ss
#   yyyyMMdd, yyyyMMdd HHmm, yyyyMMdd HHmmss
#   yyyy-DDD HH:mm:ss (whatever follows is ignored)
_DASHED = r"^(\d{2})-(\d{2})-((?!0000)\d{4})( \d{2}:\d{2}(?::\d{2})?)?$"
_SLASHED = r"^(\d{2})/(\d{2})/((?!0000)\d{4})( \d{2}:\d{2}:\d{2})?$"
_HALF_DAYS = r"^\d{2}/\d{2}/(?!0000)\d{4} \d{2}:\d{2}:\d{2} [AaPp][Mm]$"
_DOTTED_YEAR_FIRST = r"^((?!0000)\d{4})\.(\d{2})\.(\d{2})( \d{2}:\d{2}:\d{2})$"
_SLASHED_YEAR_FIRST = r"^((?!0000)\d{4})/(\d{2})/(\d{2})( \d{2}:\d{2}(?::\d{2})?)$"
_DIGITS_DAY = r"^(\d{4})(\d{2})(\d{2})$"
_DIGITS_MINUTE = r"^(\d{4})(\d{2})(\d{2}) (\d{2})(\d{2})$"
_DIGITS_SECOND = r"^(\d{4})(\d{2})(\d{2}) (\d{2})(\d{2})(\d{2})$"
_MONTH_NAME_SPACED = r"^\p{L}+ \d{2} (?!0000)\d{4} \d{2}:\d{2}:\d{2}$"
_MONTH_NAME_DASHED = r"^\p{L}+-\d{2}-(?!0000)\d{4} \d{2}:\d{2}:\d{2}$"
_DAY_OF_YEAR = r"^((?!0000)\d{4}-\d{3})\s+(\d{2}:\d{2}:\d{2})(?s:.*)$"

# --- fixed value: numbers a spreadsheet has written with an exponent ---
_EXPONENT = r"^[0-9]+\.[0-9]+[eE]\+[0-9]+$"
# Spark reads these as instants before year 1 or after year 9999.
_FAR_YEAR = r"^[\s\p{Cntrl}]*(-|\+?([1-9]\d{4,5}|0[1-9]\d{4}|0{4,6})(?!\d))"


def normalize_ts(value: Column) -> Column:
    """The text without zone words, underscores, ISO ``T``, trailing ``Z`` and exponent."""
    return plain_number(plain_notation(value))


def plain_notation(value: Column) -> Column:
    """First half of :func:`normalize_ts`. Only a ``T`` between digits is a separator, so
    month names keep theirs."""
    text = F.trim(value)
    for zone in ("UTC", "GMT"):
        text = F.replace(text, F.lit(zone), F.lit(""))
    return F.trim(F.regexp_replace(text, r"_|(?<=\d)[Tt](?=\d)|[Zz]$", " "))


def plain_number(text: Column) -> Column:
    """Second half: exponents written out, nothing left becomes NULL."""
    number = F.format_string("%.0f", text.try_cast("double"))
    return F.when(text.rlike(_EXPONENT), number).when(text != "", text)


# Shapes of the all-digit layouts and of Spark's own notation to the minute or second: what
# a text is when every digit is written as 0.
_DAYS_FIRST = tuple(f"00{sep}00{sep}0000" for sep in "-/")
_YEAR_FIRST = tuple(f"0000{sep}00{sep}00" for sep in "-./")
SHAPES = (
    *(f"{day}{time}" for day in _DAYS_FIRST for time in ("", " 00:00:00")), "00-00-0000 00:00",
    *(f"{day} 00:00:00" for day in _YEAR_FIRST), "0000-00-00 00:00", "0000/00/00 00:00",
    "0000-00-00", "00000000", "00000000 0000", "00000000 000000",
)


def known_shape(raw: Column) -> Column:
    """The shape of a text that is digits in a known layout, NULL of any other.

    Such a text is its own normal form, and :func:`parse_shaped` reads it.
    """
    return among_shapes(digits_as_zero(raw))


def digits_as_zero(raw: Column) -> Column:
    return F.translate(raw, "123456789", "000000000")


def among_shapes(zeros: Column) -> Column:
    """Second half of :func:`known_shape`, for callers that keep the first half's result."""
    return F.when(zeros.isin(*SHAPES), zeros)


def parse_shaped(raw: Column, shape: Column) -> Column:
    """What :func:`parse_timestamp` makes of a text of this shape, without a pattern: the parts
    are where the shape has them, and a cast reads them in ISO order.
    """
    part = lambda start, size=30: F.substring(raw, start, size)
    third, fifth = F.substring(shape, 3, 1), F.substring(shape, 5, 1)
    read = lambda *parts: F.concat(*parts).try_cast("timestamp")
    dash = F.lit("-")
    in_year = lambda year, instant: F.when(year != "0000", instant)
    early, late = part(7, 4), part(1, 4)
    time = F.when(
        F.length(shape) > 8,
        F.concat(
            F.lit(" "), part(10, 2), F.lit(":"), part(12, 2),
            F.when(F.length(shape) > 13, F.concat(F.lit(":"), part(14, 2))).otherwise(""),
        ),
    ).otherwise("")
    month_first = read(early, dash, part(1, 2), dash, part(4, 2), part(11))
    day_first = read(early, dash, part(4, 2), dash, part(1, 2), part(11))
    return (
        F.when(fifth == "-", in_year(late, raw.try_cast("timestamp")))
        .when(third == "-", in_year(early, day_first))
        # A cast that finds no such month throws inside, which costs more than all the rest.
        .when((third == "/") & (part(1, 2) > "12"), in_year(early, day_first))
        .when(third == "/", in_year(early, F.coalesce(month_first, day_first)))
        .when(fifth != "0", in_year(late, read(late, dash, part(6, 2), dash, part(9))))
        .otherwise(in_year(late, read(late, dash, part(5, 2), dash, part(7, 2), time)))
    )


def parse_timestamp(raw: Column, normalized: Column | None = None) -> Column:
    """The raw text read in Spark's notation, which keeps its zone, else the normalised
    text in the first layout that fits, else NULL.

    An ambiguous "03/04/2026" is month-first. Years outside 1..9999 and times of day
    without a date (Spark would put them on today) are no timestamps. ``normalized`` is
    :func:`normalize_ts` of the raw text, where the caller has it already.
    """
    if normalized is None:
        normalized = normalize_ts(raw)
    timed_only = F.instr(normalized, ":").between(1, 4) | F.lower(normalized).startswith("t")
    return F.when(
        ~timed_only, F.coalesce(_iso(raw), F.when(normalized.isNotNull(), _layouts(normalized)))
    )


def _iso(text: Column) -> Column:
    return F.when(~text.rlike(_FAR_YEAR), text.try_cast("timestamp"))


def _layouts(text: Column) -> Column:
    third, fifth = F.substring(text, 3, 1), F.substring(text, 5, 1)
    return (
        F.when(third == "-", _rewritten(text, _DASHED, "$3-$2-$1$4"))
        .when(
            third == "/",
            F.coalesce(
                _rewritten(text, _SLASHED, "$3-$1-$2$4"),
                _worded(text, _HALF_DAYS, "MM/dd/yyyy hh:mm:ss a"),
                _rewritten(text, _SLASHED, "$3-$2-$1$4"),
            ),
        )
        .when(fifth == ".", _rewritten(text, _DOTTED_YEAR_FIRST, "$1-$2-$3$4"))
        .when(fifth == "/", _rewritten(text, _SLASHED_YEAR_FIRST, "$1-$2-$3$4"))
        .when(fifth == "-", F.coalesce(_iso(text), _day_of_year(text), _month_name(text)))
        .when(text.rlike(r"^(?!0000)\d{8}$"), _rewritten(text, _DIGITS_DAY, "$1-$2-$3"))
        .when(
            text.rlike(r"^(?!0000)\d{8} "),
            F.coalesce(
                _rewritten(text, _DIGITS_SECOND, "$1-$2-$3 $4:$5:$6"),
                _rewritten(text, _DIGITS_MINUTE, "$1-$2-$3 $4:$5"),
            ),
        )
        .otherwise(F.coalesce(_iso(text), _month_name(text)))
    )


def _rewritten(text: Column, shape: str, iso: str) -> Column:
    """Read as the ISO text. A text of another shape is left alone, and no cast reads it."""
    return F.regexp_replace(text, shape, iso).try_cast("timestamp")


def _worded(text: Column, shape: str, layout: str) -> Column:
    return F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(layout)))


def _month_name(text: Column) -> Column:
    return F.coalesce(
        _worded(text, _MONTH_NAME_SPACED, "MMM dd yyyy HH:mm:ss"),
        _worded(text, _MONTH_NAME_DASHED, "MMM-dd-yyyy HH:mm:ss"),
    )


def _day_of_year(text: Column) -> Column:
    parts = F.regexp_replace(text, _DAY_OF_YEAR, "$1 $2")
    return F.when(
        text.rlike(_DAY_OF_YEAR), F.try_to_timestamp(parts, F.lit("yyyy-DDD HH:mm:ss"))
    )
