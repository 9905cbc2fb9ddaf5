"""Rows as bytes whose order is the order of the rows, and back (memcomparable keys).

Every field begins with a marker, 0 for null and 1 else, so nulls come first whichever way the field
is ordered. Integers, dates and timestamps follow as big-endian bytes with the sign bit flipped;
floating-point numbers with all bits flipped if negative, the sign bit else, so that -0.0 comes
before 0.0 and NaN last. Strings and binaries follow as they are, 00 as 00 FF, and end in 00 00. A
descending field has the bytes behind its marker inverted. All of it is done on Arrow batches, a
column at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T

#: Bytes of a type and the Arrow type that its values are cast to.
_INTEGERS = {"tinyint": (1, pa.int8()), "smallint": (2, pa.int16()), "int": (4, pa.int32()), "bigint": (8, pa.int64())}
_MOMENTS = {"date": (4, pa.int32()), "timestamp": (8, pa.int64()), "timestamp_ntz": (8, pa.int64())}
_REALS = {"float": (4, pa.float32()), "double": (8, pa.float64())}


class RowKeys:
    """The keys of rows of `schema`; `descending` names fields, none of them strings or binaries."""

    def __init__(self, schema: T.StructType, descending: tuple[str, ...] = ()) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.schema, self.names = schema, schema.names
        self.kinds = [f.dataType.simpleString() for f in schema]
        self.down = [f.name in descending for f in schema]
        self.arrow = to_arrow_schema(schema)
        for name, kind, down in zip(self.names, self.kinds, self.down):
            if kind not in (*_INTEGERS, *_MOMENTS, *_REALS, "boolean") and (down or kind not in ("string", "binary")):
                raise TypeError(f"no key for {name}, {kind}" + " descending" * down)

    def _fixed(self, column: pa.Array, kind: str, down: bool) -> np.ndarray:
        """(rows, 1 + width) bytes."""
        valid = np.asarray(column.is_valid())
        if kind in _REALS:
            width, to = _REALS[kind]
            bits = pc.fill_null(column.cast(to), 0.0).to_numpy(zero_copy_only=False).view(f"u{width}")
            sign = np.array(1 << (8 * width - 1), bits.dtype)
            bits = np.where(bits & sign, ~bits, bits ^ sign)
        elif kind == "boolean":
            width, bits = 1, pc.fill_null(column, False).to_numpy(zero_copy_only=False).astype("u1")
        else:
            width, to = (_INTEGERS | _MOMENTS)[kind]
            bits = pc.fill_null(column.view(to) if kind in _MOMENTS else column.cast(to), 0).to_numpy(zero_copy_only=False)
            bits = bits.view(f"u{width}") ^ np.array(1 << (8 * width - 1), f"u{width}")
        out = np.empty((len(valid), 1 + width), np.uint8)
        out[:, 0] = valid
        out[:, 1:] = (~bits if down else bits).astype(f">u{width}").view(np.uint8).reshape(len(valid), width)
        out[~valid] = 0
        return out

    def encode(self, columns: list[pa.Array]) -> pa.Array:
        """The key of each row, binary."""
        parts: list[pa.Array] = []
        run: list[np.ndarray] = []

        def close() -> None:
            if run:
                block = np.ascontiguousarray(np.concatenate(run, axis=1))
                parts.append(pa.FixedSizeBinaryArray.from_buffers(pa.binary(block.shape[1]), len(block), [None, pa.py_buffer(block)]).cast(pa.binary()))
                run.clear()

        for column, kind, down in zip(columns, self.kinds, self.down):
            if kind in ("string", "binary"):
                close()
                escaped = pc.replace_substring(column.cast(pa.binary()), b"\x00", b"\x00\xff")
                ended = pc.binary_join_element_wise(pa.scalar(b"\x01"), escaped, pa.scalar(b"\x00\x00"), pa.scalar(b""))
                parts.append(pc.fill_null(ended, b"\x00"))
            else:
                run.append(self._fixed(column, kind, down))
        close()
        return parts[0] if len(parts) == 1 else pc.binary_join_element_wise(*parts, pa.scalar(b""))

    def decode(self, keys: pa.Array) -> list[pa.Array]:
        """The columns of rows with these keys."""
        offsets = np.frombuffer(keys.buffers()[1], np.int32)[keys.offset : keys.offset + len(keys) + 1].astype(np.int64)
        data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        at, out, ends = offsets[:-1] - offsets[0], [], None
        for kind, down, field in zip(self.kinds, self.down, self.arrow):
            valid = data[at] == 1 if len(at) else np.zeros(0, bool)
            if kind in ("string", "binary"):
                if ends is None:
                    ends = np.flatnonzero((data[:-1] == 0) & (data[1:] == 0))
                begin = at + 1
                end = begin.copy()
                end[valid] = ends[np.searchsorted(ends, begin[valid])]
                length = end - begin
                bounds = np.append(0, np.cumsum(length))
                own = data[np.repeat(begin - bounds[:-1], length) + np.arange(bounds[-1])]
                mask = pa.py_buffer(np.packbits(valid, bitorder="little").tobytes())
                found = pa.Array.from_buffers(pa.binary(), len(at), [mask, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(own)])
                out.append(pc.replace_substring(found, b"\x00\xff", b"\x00").cast(field.type))
                at = np.where(valid, end + 2, begin)
                continue
            width = 1 if kind == "boolean" else (_INTEGERS | _MOMENTS | _REALS)[kind][0]
            bits = data[(at + 1)[:, None] + np.arange(width)].copy().view(f">u{width}").reshape(-1).astype(f"u{width}")
            bits = ~bits if down else bits
            sign = np.array(1 << (8 * width - 1), bits.dtype)
            if kind == "boolean":
                out.append(pa.array(bits == 1, mask=~valid))
            elif kind in _REALS:
                out.append(pa.array(np.where(bits & sign, bits ^ sign, ~bits).view(f"f{width}"), mask=~valid))
            else:
                plain = pa.array((bits ^ sign).view(f"i{width}"), mask=~valid)
                out.append(plain.view(field.type) if kind in _MOMENTS else plain)
            at = at + 1 + width
        return out
