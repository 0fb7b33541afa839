"""IPv4 addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DOTTED = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"


def ipv4_number(ip: Column) -> Column:
    """Dotted text -> BIGINT, NULL unless it is four octets of at most 255."""
    octets = [F.regexp_extract(ip, _DOTTED, i).try_cast("bigint") for i in range(1, 5)]
    number = sum((o * F.lit(256 ** (3 - i)) for i, o in enumerate(octets[1:], 1)), octets[0] * F.lit(256**3))
    return F.when(F.greatest(*octets) <= 255, number)


def ipv4_text(number: Column) -> Column:
    """BIGINT -> dotted text."""
    octets = [F.shiftright(number, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]
    return F.concat_ws(".", *octets)
