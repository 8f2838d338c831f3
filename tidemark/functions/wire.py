"""Encoded row images to typed columns and back, as Arrow batches.

A wide row of fixed-width fields makes one generated method too large for the JVM to
compile when it is written as built-in expressions. Here a batch of a column is one numpy
byte-swap, for every type, and the batches never leave the task that reads them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Big-endian layout of the fixed-width wire forms.
LAYOUTS = {
    T.IntegerType: ">i4",
    T.DateType: ">i4",
    T.FloatType: ">f4",
    T.LongType: ">i8",
    T.TimestampType: ">i8",
    T.TimestampNTZType: ">i8",
    T.DoubleType: ">f8",
}
TEXT_TYPES = (T.StringType, T.BinaryType, T.BooleanType, T.DecimalType)

Batches = Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def check_types(schema: T.StructType) -> None:
    """Raise for a column type that has no wire form."""
    for f in schema.fields:
        if type(f.dataType) not in LAYOUTS and not isinstance(f.dataType, TEXT_TYPES):
            raise TypeError(f"no wire form for type {f.dataType.simpleString()} of column {f.name}")


def _element(image: pa.ListArray, position: int) -> pa.BinaryArray:
    """The values at one position; NULL where a list is shorter."""
    offsets = image.offsets.to_numpy()
    starts, ends = offsets[:-1] + position, offsets[1:]
    inside = starts < ends
    index = pa.array(np.where(inside, starts, 0), mask=~inside)
    return image.values.take(index)


def _fixed(raw: pa.BinaryArray, layout: str) -> tuple[np.ndarray, np.ndarray]:
    """Values and a mask of the missing ones. Shorter non-empty values are an error."""
    width = np.dtype(layout).itemsize
    lengths = pc.binary_length(raw).fill_null(0).to_numpy(zero_copy_only=False)
    missing = lengths == 0
    if ((lengths < width) & ~missing).any():
        raise ValueError(f"encoded value is shorter than {width} bytes")
    _, offset_buffer, data_buffer = raw.buffers()
    offsets = np.frombuffer(offset_buffer, np.int32, len(raw) + 1, raw.offset * 4)[:-1]
    out = np.zeros((len(raw), width), np.uint8)
    if not missing.all():
        data = np.frombuffer(data_buffer, np.uint8)
        out[~missing] = data[offsets[~missing][:, None] + np.arange(width)]
    return out.reshape(-1).view(layout), missing


def _decoded(raw: pa.BinaryArray, kind: T.DataType, target: pa.DataType) -> pa.Array:
    if type(kind) in LAYOUTS:
        values, missing = _fixed(raw, LAYOUTS[type(kind)])
        native = pa.array(values.astype(values.dtype.newbyteorder("=")), mask=missing)
        return native.cast(target)
    present = pc.if_else(pc.equal(pc.binary_length(raw), 0), pa.scalar(None, raw.type), raw)
    if isinstance(kind, T.BinaryType):
        return present.cast(target)
    text = present.cast(pa.string())
    if isinstance(kind, T.BooleanType):
        return pc.equal(pc.utf8_lower(text), "true")
    if isinstance(kind, T.DecimalType):
        # Through a wide scale, so that surplus digits are rounded rather than refused.
        wide = text.cast(pa.decimal256(76, max(kind.scale, 30)))
        return pc.round(wide, kind.scale, "half_towards_infinity").cast(target)
    return text.cast(target)


def decoder(image: str, schema: T.StructType, output: T.StructType) -> Batches:
    """Batches with an image column to batches of the ``output`` columns.

    The image yields the columns of ``schema``; the rest are passed through by name.
    """
    check_types(schema)
    arrow = to_arrow_schema(output)
    positions = {f.name: (i, f.dataType) for i, f in enumerate(schema.fields)}

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(image)
            columns = []
            for f in arrow:
                if f.name in positions:
                    position, kind = positions[f.name]
                    columns.append(_decoded(_element(lists, position), kind, f.type))
                else:
                    columns.append(batch.column(f.name).cast(f.type))
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return decode


def _joined(columns: list[pa.Array]) -> pa.ListArray:
    """One list of values per row from equally long binary columns."""
    rows, width = len(columns[0]), len(columns)
    # Column-major to row-major order.
    order = (np.arange(rows)[:, None] + np.arange(width)[None, :] * rows).reshape(-1)
    values = pa.concat_arrays(columns).take(pa.array(order))
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * width), values)


def _encoded(values: pa.Array, kind: T.DataType) -> pa.Array:
    if type(kind) in LAYOUTS:
        layout = np.dtype(LAYOUTS[type(kind)])
        if layout.kind == "i":
            values = values.cast(pa.int32() if layout.itemsize == 4 else pa.int64())
        missing = values.is_null().to_numpy(zero_copy_only=False)
        plain = values.fill_null(0).to_numpy(zero_copy_only=False).astype(layout)
        lengths = np.where(missing, 0, layout.itemsize)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        data = plain[~missing].tobytes()
        return pa.BinaryArray.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    if isinstance(kind, (T.BooleanType, T.DecimalType)):
        values = values.cast(pa.string())
    return values.cast(pa.binary()).fill_null(b"")


def encoder(schema: T.StructType, output: T.StructType, name: str) -> Batches:
    """Inverse of :func:`decoder`: adds the image of the columns of ``schema`` as ``name``."""
    check_types(schema)
    arrow = to_arrow_schema(output)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            image = _joined([_encoded(batch.column(f.name), f.dataType) for f in schema.fields])
            columns = [(image if f.name == name else batch.column(f.name)).cast(f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return encode
