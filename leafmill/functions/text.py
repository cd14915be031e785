"""Text, time and body clean-up as column expressions."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Russian month names in the genitive, January first.
RU_MONTHS = (
    "января",
    "февраля",
    "марта",
    "апреля",
    "мая",
    "июня",
    "июля",
    "августа",
    "сентября",
    "октября",
    "ноября",
    "декабря",
)

# Fixed value: the largest number a price or a counter can hold.
MAX_UINT64 = "18446744073709551615"

# Unicode whitespace plus the four information separators.
_SPACE = r"[\s\x1c-\x1f]"
_ISO_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}(:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?\s*(Z|[+-][0-9:]+)?)?$"
_HOUR_ONLY = r"^([0-9-]{10}[T ][0-9]{2})(?![0-9:])"


def blank_to_null(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def clean_text(value: Column) -> Column:
    """Whitespace runs (no-break spaces too) become one space, ends trimmed, null becomes ''."""
    return F.coalesce(F.trim(F.regexp_replace(value, f"(?U){_SPACE}+", " ")), F.lit(""))


def strip_text(value: Column) -> Column:
    """Ends trimmed of any whitespace, inner whitespace kept, null becomes ''."""
    return F.coalesce(F.regexp_replace(value, rf"(?U)\A{_SPACE}+|{_SPACE}+\z", ""), F.lit(""))


def ru_date_iso(text: Column) -> Column:
    """`11 июня 2026 года` to `2026-06-11`; null when the first day-word-year run names no month."""
    pattern = rf"(?iuU)([0-9]{{1,2}}){_SPACE}+([а-яё]+){_SPACE}+([0-9]{{4}})"
    numbers = F.create_map(*(F.lit(x) for i, m in enumerate(RU_MONTHS, 1) for x in (m, f"{i:02d}")))
    month = numbers[F.lower(F.regexp_extract(text, pattern, 2))]
    day = F.lpad(F.regexp_extract(text, pattern, 1), 2, "0")
    return F.concat(F.regexp_extract(text, pattern, 3), F.lit("-"), month, F.lit("-"), day)


def digits_to_number(text: Column) -> Column:
    """Keep only digits and read them as a number; nothing left, or 2^64 and more, is null."""
    number = F.regexp_replace(text, "[^0-9]", "").try_cast("decimal(20,0)")
    return F.when(number <= F.lit(MAX_UINT64).cast("decimal(20,0)"), number)


def utc_literal(moment: datetime) -> Column:
    """A moment as a timestamp: an offset is converted, a time without one is UTC, whatever zone the machine is in."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc)
    return F.lit(f"{moment.replace(tzinfo=None).isoformat(sep=' ')}Z").cast("timestamp")


def utc_time(value: Column, now: Column | None = None) -> Column:
    """ISO text to a UTC timestamp; zone-less text is UTC, anything unreadable becomes `now`."""
    minutes = F.regexp_replace(value, _HOUR_ONLY, "$1:00:00")
    readable = F.when(value.rlike(_ISO_TIME), F.try_to_timestamp(minutes))
    return F.coalesce(readable, now if now is not None else F.current_timestamp())


def body_text(body: Column) -> Column:
    """Body bytes or text as valid UTF-8 text; null becomes ''."""
    return F.coalesce(F.make_valid_utf8(body.cast("string")), F.lit(""))
