"""Fixed-length vectors as ARRAY columns: scaling, linear scores, arg-max.

Each function spells the vector out element by element, as SQL text. The lengths
are small and known, so Catalyst gets plain arithmetic to compile instead of
lambdas that it would interpret for every element.
"""

from __future__ import annotations

from collections.abc import Sequence


def _double(x: float) -> str:
    return f"{float(x)!r}D"


def scaled(
    vector: str, mean: Sequence[float], std: Sequence[float], *, guard_zero: bool
) -> str:
    """``(x - mean) / std`` in float32; with ``guard_zero`` a zero ``std`` divides by nothing.

    Spark divides floats as doubles. The double quotient rounded to float is the
    float quotient, so the result is bit-equal to single precision arithmetic.
    """

    def one(i: int, m: float, s: float) -> str:
        # the cast makes the literal the nearest float32, as the constants are meant
        diff = f"CAST(get({vector}, {i}) AS float) - CAST({_double(m)} AS float)"
        if s == 0 and guard_zero:
            return diff
        return f"CAST(try_divide({diff}, CAST({_double(s)} AS float)) AS float)"

    return "array(" + ", ".join(one(i, m, s) for i, (m, s) in enumerate(zip(mean, std))) + ")"


def linear(
    inputs: Sequence[str], weights: Sequence[Sequence[float]], bias: Sequence[float]
) -> list[str]:
    """``W'x + b`` over double columns, one text per class; ``weights[i][j]`` is input ``i``, class ``j``."""
    return [
        " + ".join(f"{x} * {_double(w[j])}" for x, w in zip(inputs, weights)) + f" + {_double(b)}"
        for j, b in enumerate(bias)
    ]


def argmax(vector: str) -> str:
    """Index of the first largest element.

    NaN never beats a number; a NaN in front stays the maximum, since no number
    compares greater than it.
    """
    numbers = f"transform({vector}, x -> if(isnan(x), CAST('-Infinity' AS double), CAST(x AS double)))"
    best = f"array_position({numbers}, array_max({numbers})) - 1"
    return f"CAST(if(isnan(get({vector}, 0)), 0, {best}) AS int)"
