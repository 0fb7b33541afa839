"""Write a linear classifier with softmax as an ONNX model.

Enough of the public ONNX protobuf layout for ``Softmax(Gemm(features, W, b))``,
so a fitted linear baseline can be served through the same scoring job as any
other model file.
"""

from __future__ import annotations

import struct
from collections.abc import Sequence

_FLOAT = 1  # TensorProto.FLOAT, AttributeProto.INT is 2


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _bytes(field: int, data: bytes | str) -> bytes:
    raw = data.encode() if isinstance(data, str) else data
    return _varint(field << 3 | 2) + _varint(len(raw)) + raw


def _tensor(name: str, dims: Sequence[int], values: Sequence[float]) -> bytes:
    raw = struct.pack(f"<{len(values)}f", *values)
    head = b"".join(_number(1, d) for d in dims)
    return head + _number(2, _FLOAT) + _bytes(8, name) + _bytes(9, raw)


def _matrix_type(name: str, columns: int) -> bytes:
    shape = _bytes(1, _bytes(2, "n")) + _bytes(1, _number(1, columns))
    return _bytes(1, name) + _bytes(2, _bytes(1, _number(1, _FLOAT) + _bytes(2, shape)))


def _node(kind: str, inputs: Sequence[str], output: str, attributes: bytes = b"") -> bytes:
    names = b"".join(_bytes(1, i) for i in inputs)
    return names + _bytes(2, output) + _bytes(4, kind) + attributes


def linear_onnx(weights: Sequence[Sequence[float]], bias: Sequence[float]) -> bytes:
    """Model bytes with input ``features`` [n, inputs] and output ``output`` [n, classes]."""
    n, k = len(weights), len(bias)
    flat = [w for row in weights for w in row]
    axis = _bytes(5, _bytes(1, "axis") + _number(3, 1) + _number(20, 2))
    graph = (
        _bytes(1, _node("Gemm", ["features", "W", "b"], "logits"))
        + _bytes(1, _node("Softmax", ["logits"], "output", axis))
        + _bytes(2, "linear")
        + _bytes(5, _tensor("W", [n, k], flat))
        + _bytes(5, _tensor("b", [k], bias))
        + _bytes(11, _matrix_type("features", n))
        + _bytes(12, _matrix_type("output", k))
    )
    opset = _bytes(1, "") + _number(2, 13)
    return _number(1, 7) + _bytes(7, graph) + _bytes(8, opset)
