"""Plug-in points for models: vectorized Python over Arrow batches, one instance a worker."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docloom.operators.features import vector_columns

#: Factories of text scorers, layout detectors and OCR engines by name.
REGISTRY: dict[str, Callable[[], Callable]] = {}


def register(name: str):
    def keep(make):
        REGISTRY[name] = make
        return make

    return keep


def factory(name: str) -> Callable[[], Callable]:
    """The registered factory itself: it travels to the workers, whose registries are empty."""
    if name not in REGISTRY:
        raise ValueError(f"unknown provider {name!r}; there are {', '.join(sorted(REGISTRY))}")
    return REGISTRY[name]


def scorer(make: Callable[[], Callable[[list[str]], list[float]]], most: int = 10_000) -> Callable[[Column], Column]:
    """A text scorer as a column function: blank texts score 0 without a call, others in batches, cut at ``most`` characters, clamped to [0, 3]."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for texts in batches:
            full = texts.fillna("").str.strip()
            out = pd.Series(0.0, index=texts.index)
            some = full[full != ""]
            if len(some):
                out[some.index] = model(some.str.slice(0, most).tolist())
            yield out.clip(0.0, 3.0)

    return lambda c: score(c)


def router(make: Callable[[], Callable[[pd.DataFrame], pd.Series]]) -> Callable[[], Column]:
    """A router model over all columns of ``vector_columns()`` as one call a batch."""
    names = vector_columns()

    @F.pandas_udf("double")
    def prob(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        model = make()
        for frame in batches:
            frame.columns = names
            yield pd.Series(model(frame)).astype(float)

    return lambda: prob(F.struct(*(F.col(n) for n in names)))


def parser(documents: DataFrame, make: Callable[[], Callable[[bytes], list[dict]]], schema: str, key: str = "sha256", content: str = "content") -> DataFrame:
    """Documents to segments by a parser of bytes: rows of ``schema`` (that begins with the key and ends with error string).

    A document that a parser can't read gives one row with its error text and never fails the job.
    """
    names = [part.strip().split()[0] for part in schema.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parse = make()
        for frame in batches:
            rows = []
            for k, blob in zip(frame[key], frame[content], strict=True):
                try:
                    rows += [{key: k, "error": None} | r for r in parse(blob)]
                except Exception as e:  # noqa: BLE001
                    rows.append({key: k, "error": f"{type(e).__name__}: {e}"[:500]})
            yield pd.DataFrame(rows, columns=names, dtype=object)

    return documents.select(key, content).mapInPandas(run, schema)
