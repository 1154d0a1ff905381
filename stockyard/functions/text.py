"""Text cleaning and strict-format parsing. Every function is Column -> Column."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockyard.fixed_values import DATE_FORMAT, TIMESTAMP_FORMAT


_FIELDS = re.compile("yyyy|MM|dd|HH|mm|ss")


def _fixed_width(text: Column, fmt: str) -> Column | None:
    """Parse by position and cast, or None if ``fmt`` has other letters than the plain fields."""
    places = {m.group(): m.start() + 1 for m in _FIELDS.finditer(fmt)}
    if re.search("[A-Za-z]", _FIELDS.sub("", fmt)) or not {"yyyy", "MM", "dd"} <= places.keys():
        return None
    shape = "^" + _FIELDS.sub(lambda m: "[0-9]{%d}" % len(m.group()), re.sub(r"([^A-Za-z ])", r"\\\1", fmt)) + r"\z"
    if fmt in (TIMESTAMP_FORMAT, DATE_FORMAT):
        ordered = text
    else:
        def field(name):
            return F.substring(text, places[name], len(name)) if name in places else F.lit("00")
        ordered = F.concat(field("yyyy"), F.lit("-"), field("MM"), F.lit("-"), field("dd"), F.lit(" "),
                           field("HH"), F.lit(":"), field("mm"), F.lit(":"), field("ss"))
    return F.when(F.rlike(text, F.lit(shape)), ordered.try_cast("timestamp_ntz"))


def parse_ts(text: Column, *formats: str) -> Column:
    """First format that fits ``text`` exactly, as a timestamp without zone; NULL if none does.

    Formats of plain fixed-width fields are matched by shape and cast, which needs no session
    zone and is several times faster than a pattern parser that raises on each misfit. Signed
    years and other formats go to the pattern parser, read in the session zone (UTC).
    """
    tries = []
    for fmt in formats or (TIMESTAMP_FORMAT,):
        by_pattern = F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")
        by_shape = _fixed_width(text, fmt)
        if by_shape is None:
            tries.append(by_pattern)
        else:
            tries += [by_shape, F.when(F.startswith(text, F.lit("+")), by_pattern)]
    return F.coalesce(*tries)


def parse_ts_or_date(text: Column, *extra_formats: str) -> Column:
    """A full timestamp, a bare date, or any of ``extra_formats``."""
    return parse_ts(text, TIMESTAMP_FORMAT, DATE_FORMAT, *extra_formats)


def clean_text(text: Column) -> Column:
    return F.upper(F.trim(text))


def repair_decimal(text: Column, precision: int, scale: int, strict: bool = False) -> Column:
    """Decimal comma to point, then cast. ``strict`` raises on other text, else NULL."""
    fixed = F.translate(text, ",", ".")
    kind = f"decimal({precision},{scale})"
    return fixed.cast(kind) if strict else fixed.try_cast(kind)


def extract_code(text: Column) -> Column:
    """The digits of ``text`` as an int; NULL without digits or beyond the int range."""
    return F.regexp_replace(text, "[^0-9]", "").try_cast("int")
