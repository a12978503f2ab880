"""Fixed-width text fields built from Spark column expressions.

A record is a list of ``Field(name, width, column)``; ``fixed_width`` concatenates
them. Helpers never truncate: a value wider than its field is kept whole so
that the record-length gate downstream rejects the line instead of silently
emitting a wrong number.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the visible blank used while a record is assembled; it is
# replaced by a space once the line passes the length gate.
BLANK = "_"


@dataclass(frozen=True)
class Field:
    name: str
    width: int
    column: Column


@dataclass(frozen=True)
class Slot:
    """A place in a record: ``text``, ``int`` (sign included), ``date`` (ddMMyy), ``money`` (whole part and
    two decimals without a point) or ``blank``."""

    name: str
    width: int
    kind: str = "text"


@dataclass(frozen=True)
class Layout:
    """The slots of one record type, in order; the same table writes records and reads them."""

    record_type: int
    slots: tuple[Slot, ...]

    @property
    def width(self) -> int:
        return sum(s.width for s in self.slots)

    def positions(self) -> list[tuple[Slot, int]]:
        """Each slot with its first character, counted from 1."""
        out, start = [], 1
        for slot in self.slots:
            out.append((slot, start))
            start += slot.width
        return out

    def fields(self, **values: Column) -> list[Field]:
        """The record's fields from typed values, one for every slot that is neither blank nor the record type."""
        wanted = {s.name for s in self.slots if s.kind != "blank"} - {RECORD_TYPE}
        if set(values) != wanted:
            raise ValueError(f"record {self.record_type}: values {sorted(values)} for slots {sorted(wanted)}")
        values[RECORD_TYPE] = F.lit(str(self.record_type))
        return [Field(s.name, s.width, blank(s.width) if s.kind == "blank" else _written(s, values[s.name])) for s in self.slots]

    def parsed(self, record: Column, latest_year: int) -> dict[str, Column]:
        """Typed values of a line by slot, null where a field is empty or does not parse.

        Two-digit years lie in the hundred years up to ``latest_year``.
        """
        return {s.name: _read(s, F.substring(record, start, s.width), latest_year)
                for s, start in self.positions() if s.kind != "blank"}

    def unreadable(self, record: Column, latest_year: int) -> Column:
        """The first field that does not read back as its kind, else null; blank fields must be blank."""
        bad = [F.when(F.trim(F.substring(record, start, s.width)) != "" if s.kind == "blank" else values.isNull(), F.lit(s.name))
               for s, start in self.positions()
               for values in [None if s.kind == "blank" else _read(s, F.substring(record, start, s.width), latest_year)]]
        return F.when(F.length(record) != self.width, F.lit("length")).otherwise(F.coalesce(*bad))


RECORD_TYPE = "record_type"


def _written(slot: Slot, value: Column) -> Column:
    if slot.kind == "date":
        return ddmmyy(value)
    if slot.kind == "int":
        return signed_int(value, slot.width)
    if slot.kind == "money":
        return F.concat(*money_parts(value, slot.width - 2))
    return value


def _read(slot: Slot, text: Column, latest_year: int) -> Column:
    if slot.kind == "text":
        return text
    if slot.kind == "int":
        return F.when(text.rlike("^-?[0-9]+$"), text).try_cast("int")
    if slot.kind == "money":
        return (F.when(text.rlike("^-?[0-9]+$"), text).try_cast("decimal(18,0)") / 100).cast(f"decimal({slot.width + 4},2)")
    first = latest_year - 99
    year = F.pmod(F.substring(text, 5, 2).try_cast("int") - first, F.lit(100)) + first
    day = F.concat_ws("-", year.cast("string"), F.substring(text, 3, 2), F.substring(text, 1, 2))
    return F.when(text.rlike("^[0-9]{6}$"), day).try_cast("date")


def blank(n: int) -> Column:
    return F.lit(BLANK * n)


def pad_left(s: Column, width: int, fill: str = "0") -> Column:
    """``lpad`` that keeps over-long values whole (``lpad`` alone truncates)."""
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, fill))


def signed_int(n: Column, width: int = 2) -> Column:
    """Integer zero-padded to ``width`` characters, sign included (``%0Nd``)."""
    digits = F.abs(n).cast("string")
    return F.when(n < 0, F.concat(F.lit("-"), pad_left(digits, width - 1))).otherwise(
        pad_left(digits, width)
    )


def money_parts(amount: Column, whole_width: int) -> tuple[Column, Column]:
    """Split a 2-decimal amount into a zero-padded whole part and 2 hundredths digits.

    Same text as formatting the amount to ``whole_width + 3`` characters with two
    decimals and zero fill, then cutting at the point: 123.45 with width 8 gives
    ("00000123", "45"); -3.5 gives ("-0000003", "50").
    """
    absolute = F.abs(amount)
    whole = F.floor(absolute).cast("bigint").cast("string")
    hundredths = ((absolute * 100).cast("bigint") % 100).cast("string")
    whole_field = F.when(
        amount < 0, F.concat(F.lit("-"), pad_left(whole, whole_width - 1))
    ).otherwise(pad_left(whole, whole_width))
    return whole_field, F.lpad(hundredths, 2, "0")


def ddmmyy(d: Column | str) -> Column:
    return F.date_format(d, "ddMMyy")


def fixed_width(fields: list[Field]) -> Column:
    return F.concat(*[f.column for f in fields])


def wrong_width(fields: list[Field]) -> Column:
    """``width <name>`` of the first field whose text is not as wide as the field, else null.

    Line length alone would let a short field make up for a long one.
    """
    return F.coalesce(*[F.when(F.length(f.column) != f.width, F.lit(f"width {f.name}")) for f in fields])


def layout_width(fields: list[Field]) -> int:
    return sum(f.width for f in fields)
