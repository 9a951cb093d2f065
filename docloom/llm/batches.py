"""Arrow plumbing for operators over whole texts: bounded blocks in, columns out."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

#: A block holds whole texts of at least one row and, beyond that, of at most so many characters.
BLOCK_CHARS = 1_000_000


def blocks(batch: pa.RecordBatch, text_at: int, most: int = BLOCK_CHARS) -> Iterator[tuple[list[list], list[str]]]:
    """Split an Arrow batch into (key columns, texts); NULL texts become ''."""
    texts = [t or "" for t in batch.column(text_at).to_pylist()]
    keys = [batch.column(i).to_pylist() for i in range(batch.num_columns) if i != text_at]
    start, chars = 0, 0
    for i, text in enumerate(texts):
        if i > start and chars + len(text) > most:
            yield [k[start:i] for k in keys], texts[start:i]
            start, chars = i, 0
        chars += len(text)
    if start < len(texts):
        yield [k[start:] for k in keys], texts[start:]


def map_texts(df: DataFrame, keys: list[str], text: str, schema: str, make: Callable[[], Callable[[list[list], list[str]], dict]]) -> DataFrame:
    """``make()`` runs once per task and gives ``f(key columns, texts) -> {column: values}``; output follows ``schema``."""
    names = [part.split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        for batch in batches:
            for key_columns, texts in blocks(batch, len(keys)):
                out = f(key_columns, texts)
                yield pa.RecordBatch.from_arrays([pa.array(out[n], type=types[n]) for n in names], names=names)

    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(), "float": pa.float32()}
    types = {part.split()[0]: kinds[part.split()[1]] for part in schema.split(",")}
    return df.select(*keys, text).mapInArrow(run, schema)
