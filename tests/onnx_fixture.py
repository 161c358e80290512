"""A tiny ONNX model (Flatten -> MatMul -> Add) serialised with a minimal
protobuf writer, so the ONNX scorer can be tested without the ``onnx``
package."""

import numpy as np


def _varint(n: int) -> bytes:
    out = bytearray()
    while True:
        b = n & 0x7F
        n >>= 7
        if n:
            out.append(b | 0x80)
        else:
            out.append(b)
            return bytes(out)


def _key(field: int, wire: int) -> bytes:
    return _varint((field << 3) | wire)


def _int(field: int, v: int) -> bytes:
    return _key(field, 0) + _varint(v)


def _bytes(field: int, v: bytes) -> bytes:
    return _key(field, 2) + _varint(len(v)) + v


def _str(field: int, v: str) -> bytes:
    return _bytes(field, v.encode())


def _tensor(name: str, arr: np.ndarray) -> bytes:
    arr = np.ascontiguousarray(arr, dtype=np.float32)
    body = b"".join(_int(1, d) for d in arr.shape) + _int(2, 1) + _str(8, name) + _bytes(9, arr.tobytes())
    return body


def _value_info(name: str, dims) -> bytes:
    shape = b"".join(_bytes(1, _int(1, d) if isinstance(d, int) else _str(2, d)) for d in dims)
    tensor_type = _int(1, 1) + _bytes(2, shape)
    return _str(1, name) + _bytes(2, _bytes(1, tensor_type))


def _node(op: str, inputs, outputs, attrs: bytes = b"") -> bytes:
    return b"".join(_str(1, i) for i in inputs) + b"".join(_str(2, o) for o in outputs) + _str(4, op) + attrs


def linear_model_bytes(weights: np.ndarray, bias: np.ndarray, input_dims) -> bytes:
    """Model: scores = flatten(x) @ weights.T + bias; ``input_dims`` without
    the batch dimension."""
    k, d = weights.shape
    flatten_axis = _bytes(5, _str(1, "axis") + _int(3, 1) + _int(20, 2))
    graph = (
        _bytes(1, _node("Flatten", ["x"], ["flat"], flatten_axis))
        + _bytes(1, _node("MatMul", ["flat", "wt"], ["mm"]))
        + _bytes(1, _node("Add", ["mm", "b"], ["scores"]))
        + _str(2, "linear")
        + _bytes(5, _tensor("wt", weights.T))
        + _bytes(5, _tensor("b", bias))
        + _bytes(11, _value_info("x", ["n", *input_dims]))
        + _bytes(12, _value_info("scores", ["n", k]))
    )
    opset = _str(1, "") + _int(2, 13)
    return _int(1, 8) + _str(2, "lookout-tests") + _bytes(7, graph) + _bytes(8, opset)

