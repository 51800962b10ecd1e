"""Token counts by a map-side lookup in two tiers; no pre-token is shuffled."""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from opslake.llm.blocks import encoded

#: Fixed value: the pattern that splits text before the merges of the byte-level vocabulary.
PRETOKEN = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Code points outside these ranges may fall in other classes of the library's Unicode version.
UNSURE = regex.compile(r"[^\x00-\u0557\u2000-\u2070]")


def byte_chars() -> dict[int, str]:
    """Characters that stand for the 256 bytes in byte-level vocabularies: printable ones for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHARS = byte_chars()


class PretokenCounts(dict):
    """Tokens of a pre-token: the shared table of frequent ones, then this worker's own cache.

    The cache holds ``most`` entries beside the table and starts anew when it is full.
    """

    def __init__(self, path: str, table: dict[str, int], most: int):
        super().__init__(table)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model = self.tokenizer.model
        self.table, self.most = table, len(table) + most
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True))) or r"(?!)")

    def __missing__(self, pretoken: str) -> int:
        n = len(self.model.tokenize(pretoken.encode().decode("latin-1").translate(BYTE_CHARS)))
        if len(self) >= self.most:
            self.clear()
            self.update(self.table)
        self[pretoken] = n
        return n

    def of(self, text: str) -> int:
        if UNSURE.search(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self.special.split(text)
        return len(parts) - 1 + sum(sum(map(self.__getitem__, PRETOKEN.findall(part))) for part in parts)


@lru_cache(maxsize=1)
def worker_counts(path: str, table: bytes, most: int) -> PretokenCounts:
    """The cache of this worker process; it lives on from task to task."""
    return PretokenCounts(path, json.loads(zlib.decompress(table)), most)


def frequent_pretokens(docs: DataFrame, path: str, doc_id: str, text: str, size: int, sample_rows: int,
                       sample_chars: int) -> bytes:
    """Compact table of frequent pre-tokens with their numbers of tokens, as compressed JSON.

    It comes from a sample of at most ``sample_rows`` texts (those with the smallest hashes of their ids, at most
    ``sample_chars`` of each) and only decides which lookups are quick, never a count.
    """
    place = F.xxhash64(F.col(doc_id))
    cut = docs.select(place.alias("p")).orderBy("p").limit(sample_rows).agg(F.max("p").alias("p")).first().p
    picked = docs.where((place <= (cut or 0)) & F.col(text).isNotNull()).select(
        F.substring(F.col(text), 1, sample_chars).alias("t")).limit(sample_rows)
    seen: Counter[str] = Counter()
    for row in picked.toLocalIterator():
        seen.update(PRETOKEN.findall(row.t))
    counts = PretokenCounts(path, {}, size)
    return zlib.compress(json.dumps({p: counts[p] for p, _ in seen.most_common(size)}).encode())


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, doc_id: str = "doc_id", text: str = "text",
                 table_size: int = 50_000, cache_size: int = 400_000, sample_rows: int = 2_000,
                 sample_chars: int = 10_000) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    ``tokenizer`` is the path of a byte-level tokenizer file that every executor can read. A null or empty text
    has 0 bytes and 0 tokens; repeated rows and null ids are kept, one result row each; other columns are not
    read. Special strings inside a text are one token, as the library has it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        frequent_pretokens(docs, tokenizer, doc_id, text, table_size, sample_rows, sample_chars))

    def count(batches):
        counts = worker_counts(tokenizer, shared.value, cache_size)
        for batch in batches:
            texts = encoded(batch.column(1))
            tokens = [counts.of(t.decode("utf-8", "replace")) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(tokens, pa.int64()),
                 pa.array([n > limit for n in tokens], pa.bool_())],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(
        count, f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
