"""Column helpers for missing values, dates and numbers. All are safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import schemas as S


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_missing(c: Column | str, extra: Iterable[str] = ()) -> Column:
    """NULL, the text NULL, or blank. `extra` adds further texts that count as missing."""
    c = _col(c)
    return c.isNull() | c.isin("NULL", "", *extra)


def present(c: Column | str) -> Column:
    """True for a non-null text that holds more than whitespace."""
    return F.coalesce(F.trim(_col(c)) != "", F.lit(False))


def parse_timestamp(c: Column | str) -> Column:
    """Text to timestamp; anything unreadable becomes NULL."""
    return F.try_to_timestamp(_col(c))


def parse_date(c: Column | str) -> Column:
    return F.try_to_timestamp(_col(c)).cast("date")


def parse_number(c: Column | str) -> Column:
    return _col(c).try_cast("double")


def open_end(c: Column) -> Column:
    """A missing interval end becomes the open-end sentinel."""
    return F.coalesce(c, F.lit(S.OPEN_END).cast("timestamp"))


def reason_defaults(text: str = S.REASON_TEXT_DEFAULT) -> dict[str, str]:
    return {"REASONCODE": S.REASON_CODE_DEFAULT, "REASONDESCRIPTION": text}
