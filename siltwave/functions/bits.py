"""Classes and fields of 16-bit readout words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the word format: mask, shift and value of each class; of each field mask and shift.
CLASSES = {
    "final_trailer": (0x7000, 12, 7), "header": (0x7000, 12, 6), "first_line": (0x7000, 12, 3), "channel_id": (0x7000, 12, 1),
    "data_trailer": (0x6000, 13, 2), "data_header": (0x6000, 13, 1), "data": (0x6000, 13, 0),
}
FIELDS = {
    "zs": (0x400, 10), "feu": (0xFF, 0), "event_part": (0xFFF, 0), "sample_id": (0xFF8, 3), "channel": (0x3F, 0), "chip_raw": (0xE00, 9),
    "chip_zs": (0x1C0, 6), "adc": (0xFFF, 0), "end_of_event": (0x800, 11), "time_part": (0xFFF, 0), "ftst": (0x7, 0),
}


def field(word: Column, name: str) -> Column:
    mask, shift = FIELDS[name]
    return F.shiftright(word.bitwiseAND(mask), shift)


def is_class(word: Column, name: str) -> Column:
    mask, shift, value = CLASSES[name]
    return F.shiftright(word.bitwiseAND(mask), shift) == value


def header_fields(w) -> dict[str, Column]:
    """Event id, timestamp, sample id and fine timestamp from the eight header words; ``w(i)`` is the i-th one."""
    part = lambda i: field(w(i).cast("long"), "event_part")
    return {
        "event_id": part(1) + F.shiftleft(part(4), 12),
        "timestamp": part(2) + F.shiftleft(part(5), 12) + F.shiftleft(part(6), 24) + F.shiftleft(w(7).cast("long").bitwiseAND(0xFF), 36),
        "sample_id": (F.shiftright(w(0).bitwiseAND(0x800), 3) + field(w(3), "sample_id")).cast("long"),
        "ftst": field(w(3), "ftst").cast("long"),
    }


def words(content: Column) -> Column:
    """Big-endian words of a short binary value, by built-in functions; the decode job has a vectorised way."""
    n = F.floor(F.octet_length(content) / 2).cast("int")
    return F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.conv(F.hex(F.substring(content, i * 2 - 1, F.lit(2))), 16, 10).cast("int"))
