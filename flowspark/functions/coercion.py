"""Lenient reading of JSON numbers held as VARIANT.

The rules: fractions are cut off, numeric text counts as its number, ``true`` is
1, and a JSON null, object, array or any other text is 0. An absent key stays
NULL, and so does a number beyond the range of the target type: the parser tells
the two apart and sets both aside rather than letting a value wrap around.
"""

from __future__ import annotations

# Exclusive bounds within which a double can be cut to the type without overflow.
_BOUNDS = {
    "int": ("-2147483649D", "2147483648D"),
    "bigint": ("-9223372036854777856D", "9223372036854775808D"),
}


def lenient_number(value: str, kind: str) -> str:
    """SQL text that reads the VARIANT expression ``value`` as ``int``, ``bigint`` or ``double``."""
    number = f"try_variant_get({value}, '$', 'double')"
    zero = f"CASE WHEN {value} IS NOT NULL AND {number} IS NULL THEN CAST(0 AS {kind}) END"
    if kind == "double":
        return f"coalesce({number}, {zero})"
    low, high = _BOUNDS[kind]
    cut = (
        f"CASE WHEN isnan({number}) THEN CAST(0 AS {kind}) "
        f"WHEN {number} > {low} AND {number} < {high} THEN CAST({number} AS {kind}) END"
    )
    if kind == "bigint":
        # whole numbers above 2^53 must not pass through a double
        return f"coalesce(try_variant_get({value}, '$', 'bigint'), {cut}, {zero})"
    return f"coalesce({cut}, {zero})"
