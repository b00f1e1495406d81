"""Reading Arrow batches in pieces of bounded size, inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

PIECE_BYTES = 4 << 20


def _widths(column: pa.Array) -> list[int]:
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        return pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    return [0] * len(column)


def pieces(batches: Iterator[pa.RecordBatch], text: str, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose `text` column holds about `limit` bytes; one longer text is a slice of its own."""
    import pyarrow.compute  # noqa: F401  makes pa.compute known

    for batch in batches:
        widths, start, held = _widths(batch.column(text)), 0, 0
        for i, width in enumerate(widths):
            if held and held + width > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += width + 64
        if start < len(widths):
            yield batch.slice(start)


def raw(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null is empty."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    """Texts of a column; null is empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def table(schema: pa.Schema, columns: dict[str, object]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], type=f.type) for f in schema], schema=schema)
