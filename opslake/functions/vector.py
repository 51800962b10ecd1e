"""Vector arithmetic on array columns, and the hash embedding."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; 0.0 when one of them has no length."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, 0.0).otherwise(dot(a, b) / norms)


def hash_embed(text: Column, dims: int = 32, unit: bool = True) -> Column:
    """Bytes of the text's SHA-256 digest over 255, of unit length on request; no model needed."""
    if not 1 <= dims <= 32:
        raise ValueError("a digest holds 32 bytes")
    # The digest is computed once per row: as a one-element array it is bound before its use.
    digest = F.array(F.sha2(text, 256))
    raw = F.flatten(F.transform(digest, lambda h: F.transform(
        F.sequence(F.lit(0), F.lit(dims - 1)),
        lambda i: F.conv(F.substring(h, i * 2 + 1, F.lit(2)), 16, 10).cast("double") / 255.0)))
    if not unit:
        return raw
    # The same binding keeps the norm from being computed once per element.
    measured = F.transform(F.array(raw), lambda v: F.struct(v.alias("v"), F.sqrt(dot(v, v)).alias("norm")))
    return F.flatten(F.transform(measured, lambda m: F.transform(
        m["v"], lambda x: F.when(m["norm"] > 0, x / m["norm"]).otherwise(x))))


def model_embed(load: Callable[[], Callable[[list[str]], list]], batch: int = 64):
    """Embedding function of a model that every worker loads once.

    ``load`` returns the model's encode function. Texts arrive in Arrow batches and are encoded
    in groups of ``batch``.
    """
    @F.pandas_udf("array<float>")
    def embed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load()
        for texts in batches:
            vectors: list = []
            for start in range(0, len(texts), batch):
                vectors.extend(encode(texts.iloc[start:start + batch].fillna("").tolist()))
            yield pd.Series(vectors)

    return embed


def hash_encoder() -> Callable[[list[str]], list]:
    """Stand-in model with the same values as :func:`hash_embed`."""
    import hashlib
    import math

    def encode(texts: list[str]) -> list:
        vectors = []
        for text in texts:
            raw = [b / 255.0 for b in hashlib.sha256(text.encode()).digest()]
            norm = math.sqrt(sum(x * x for x in raw)) or 1.0
            vectors.append([x / norm for x in raw])
        return vectors

    return encode
