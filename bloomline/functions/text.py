"""Text, number and date expressions of the cleaning job; all native, none raises on odd input."""

from __future__ import annotations

import functools
import itertools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: stands for missing text everywhere.
MISSING = "sin_info"


def _accents() -> tuple[str, str]:
    """Latin letters with marks and the letters below the marks."""
    pairs = []
    for code in range(0xC0, 0x250):
        plain = "".join(c for c in unicodedata.normalize("NFKD", chr(code)) if not unicodedata.combining(c))
        if len(plain) == 1 and plain != chr(code):
            pairs.append((chr(code), plain))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


MARKED, PLAIN = _accents()
COMBINING = "".join(map(chr, range(0x300, 0x370)))


def fix_mojibake(x: Column) -> Column:
    """UTF-8 that was once read as Latin-1, put right; anything else as it is."""
    raw = F.encode(x, "ISO-8859-1").cast("string")
    suspect = (F.contains(x, F.lit("Ã")) | F.contains(x, F.lit("Â"))) & x.rlike("^[\\u0000-\\u00ff]*$")
    return F.when(suspect, F.coalesce(F.try_validate_utf8(raw), x)).otherwise(x)


def strip_accents(x: Column) -> Column:
    """Letters without their marks; marks of their own are dropped (translate deletes what has no counterpart)."""
    return F.translate(x, MARKED + COMBINING, PLAIN)


#: Spellings of nothing that lower case makes empty or "nan".
_NOTHING = ["", *("".join(c) for c in itertools.product("nN", "aA", "nN"))]


def _tidy(text: Column) -> Column:
    """ASCII without white space other than single blanks inside, and not a spelling of nothing: only lower case is left to do. Told without
    a pattern."""
    odd = [F.contains(text, F.lit(c)) for c in ("  ", "\t", "\n", "\r", "\x0b", "\f")]
    odd += [F.startswith(text, F.lit(" ")), F.endswith(text, F.lit(" ")), text.isin(_NOTHING)]
    return functools.reduce(lambda a, b: a & ~b, odd, F.octet_length(text) == F.char_length(text))


def _untidy(text: Column) -> Column:
    spaced = F.trim(F.regexp_replace(F.lower(strip_accents(fix_mojibake(text))), "\\s{2,}|[^\\S ]", " "))
    return F.coalesce(F.regexp_replace(spaced, "^(nan)?$", MISSING), F.lit(MISSING))


def normalize_text(x: Column) -> Column:
    """x: a column or cheap expression. Nearly all texts are tidy.

    The work on others stands in a lambda, which Spark evaluates without generated code: over many columns it would be more code than one
    method may hold, and then nothing of the plan's step is compiled."""
    text = x.cast("string")
    return F.when(_tidy(text), F.lower(text)).otherwise(F.get(F.transform(F.array(text), _untidy), F.lit(0)))


def key_part(x: Column) -> Column:
    """What lower-case text adds to a key; null for nothing."""
    return F.nullif(F.btrim(F.regexp_replace(x, "[^a-z0-9]+", "_"), F.lit("_")), F.lit(""))


def join_parts(*parts: Column | str) -> Column:
    """The key of several parts: the same as that of their texts joined by a separator, but each text meets the pattern once, however many
    keys it is in."""
    return F.coalesce(F.nullif(F.concat_ws("_", *parts), F.lit("")), F.lit(MISSING))


def key_of(x: Column) -> Column:
    """A key from text that is normalised already."""
    return F.when(x.isNotNull(), F.coalesce(key_part(x), F.lit(MISSING)))


def normalize_key(x: Column) -> Column:
    return F.coalesce(key_part(normalize_text(x)), F.lit(MISSING))


def part_of(column: str) -> Column:
    return key_part(F.lower(F.coalesce(F.col(column).cast("string"), F.lit(MISSING))))


def combine_key(*columns: str) -> Column:
    """One key of several columns that hold normalised text or labels."""
    return join_parts(*map(part_of, columns))


def to_number(x: Column) -> Column:
    digits = F.regexp_replace(F.regexp_replace(x.cast("string"), ",", "."), "[^0-9\\-.]", "")
    return F.coalesce(digits.try_cast("double"), F.lit(0.0))


def normalize_client_code(code: Column) -> Column:
    """Codes that were once read as numbers lose their trailing .0."""
    return F.regexp_replace(F.trim(code.cast("string")), "\\.0$", "")


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0 or null."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def date_from(x: Column, day_first: bool) -> Column:
    """ISO dates, or day and month separated by / or - in the given order."""
    text = F.trim(x.cast("string"))
    formats = ["yyyy-MM-dd", "yyyy/MM/dd"] + (["d/M/yyyy", "d-M-yyyy"] if day_first else ["M/d/yyyy", "M-d-yyyy"])
    head = F.regexp_extract(text, "^([0-9]+[-/][0-9]+[-/][0-9]+)", 1)
    return F.coalesce(*[F.try_to_timestamp(head, F.lit(f)).cast("date") for f in formats])


def calendar(day: Column) -> dict[str, Column]:
    """ISO year and week (not those of the calendar), month and weekday."""
    year, week = F.extract(F.lit("YEAROFWEEK"), day), F.weekofyear(day)
    return {
        "iso_year": year,
        "iso_week": week,
        "year_week": F.concat(year.cast("string"), F.lit("-W"), F.lpad(week.cast("string"), 2, "0")),
        "month": F.month(day),
        "dow": F.weekday(day) + 1,
        "day_name": F.date_format(day, "EEEE"),
        "week_start": F.date_trunc("week", day).cast("date"),
    }


def week_start(year: Column, week: Column) -> Column:
    """Monday of an ISO week; a week 53 that a year lacks is the next year's first."""
    return F.date_add(F.date_trunc("week", F.make_date(year, F.lit(1), F.lit(4))).cast("date"), (week - 1) * 7)
