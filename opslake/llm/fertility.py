"""Quality rules on how well a public vocabulary fits a text, with bands per script."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslake.llm.blocks import Block, blocks, covered, prefix_hash, span_hash, window_hash

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True

#: Bands per script: fewest and most characters per token, most byte-fallback share, least token entropy in bits.
#: They are wide: a text leaves them when its words are no language of the script at all, or when it says one
#: thing over and over. Entropy counts from ``ENTROPY_TOKENS`` tokens on, as a short text cannot have much.
BANDS = {
    "latin": (1.15, 9.0, 0.10, 3.0),
    "cyrillic": (0.9, 7.0, 0.10, 3.0),
    "greek": (0.5, 5.0, 0.40, 3.0),
    "cjk": (0.25, 3.0, 0.90, 2.5),
    "other": (0.2, 9.0, 0.97, 2.0),
}
ENTROPY_TOKENS = 64
SCHEMA = ("doc_id {}, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "script string, chars_per_token double, byte_share double, token_entropy double, base_failed boolean, "
          "kept boolean")


def scripts(block: Block) -> list[str]:
    """Script of most letters, told from UTF-8 lead bytes: one-byte letters and lead C3-C9 are Latin."""
    d = block.data
    latin = block.sums(((d | 32) >= 97) & ((d | 32) <= 122) & (d < 128) | (d >= 0xC3) & (d <= 0xCA))
    greek = block.sums((d >= 0xCD) & (d <= 0xCF))
    cyrillic = block.sums((d >= 0xD0) & (d <= 0xD3))
    cjk = block.sums((d >= 0xE3) & (d <= 0xED))
    other = block.sums((d >= 0xD4) & (d <= 0xE1) | (d >= 0xF0))
    names = np.array(["latin", "greek", "cyrillic", "cjk", "other"])
    return names[np.argmax([latin, greek, cyrillic, cjk, other], axis=0)].tolist()


def repeats(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs, by place."""
    _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    return times[place]


def base_counts(block: Block, words, hashes: np.ndarray, window: int = 8) -> dict[str, np.ndarray]:
    n_docs = len(block.texts)
    lead = ((block.data & 0xC0) != 0x80) & ~words.white
    # Lines: the line feed after every document ends its last line.
    ends = np.flatnonzero(block.data == 10)
    starts = np.append(0, ends[:-1] + 1)
    filled = np.searchsorted(words.start, ends) > np.searchsorted(words.start, starts)
    starts, ends = starts[filled], ends[filled]
    line_doc = np.searchsorted(block.ends, starts)
    line = span_hash(prefix_hash(block.data), starts, ends)
    line ^= line_doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    first = np.unique(line, return_index=True)[1]
    distinct = np.bincount(line_doc[first], minlength=n_docs)
    # Windows found twice in the document.
    whole = words.whole(window)
    place = np.flatnonzero(whole)
    keys = window_hash(hashes, window)[place] ^ words.doc[place].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    again = place[repeats(keys) > 1] if len(place) else place
    marked = covered(len(hashes), again, window)
    return {
        "n_words": words.count,
        "word_chars": block.sums(lead),
        "n_symbols": block.sums(SYMBOLS[block.data]),
        "n_dup_lines": np.bincount(line_doc, minlength=n_docs) - distinct,
        "n_repeat_words": np.bincount(words.doc[marked], minlength=n_docs),
    }


def token_figures(model, block: Block, words, hashes: np.ndarray, byte_ids: np.ndarray) -> tuple[np.ndarray, ...]:
    """Tokens, byte-fallback tokens and token entropy of every document; a distinct word is encoded once a block."""
    n_docs = len(block.texts)
    _, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    ids = model.encode([words.text(i).decode("utf-8", "replace") for i in first], num_threads=1)
    sizes = np.array([len(x) for x in ids], np.int64)
    flat = np.fromiter((t for x in ids for t in x), np.int64, sizes.sum())
    begin = np.cumsum(sizes) - sizes
    per_word = sizes[place]
    at = np.repeat(begin[place] - (np.cumsum(per_word) - per_word), per_word) + np.arange(per_word.sum())
    token, doc = flat[at], np.repeat(words.doc, per_word)
    total = np.bincount(doc, minlength=n_docs)
    fallback = np.bincount(doc[byte_ids[token]], minlength=n_docs)
    key = np.sort(doc * np.int64(len(byte_ids)) + token)
    edge = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.diff(np.append(edge, len(key)))
    owner = key[edge] // len(byte_ids)
    share = times / np.maximum(total[owner], 1)
    entropy = np.bincount(owner, weights=-share * np.log2(share), minlength=n_docs) if len(owner) else np.zeros(n_docs)
    return total, fallback, entropy


def fertility_rules(docs: DataFrame, vocabulary: str, bands: dict[str, tuple] | None = None, doc_id: str = "doc_id",
                    text: str = "text", min_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """Base counts, the three tokeniser figures and the verdict of every row.

    ``vocabulary`` is the path of a piece model with byte fallback. A null or empty text has no words, figures of 0
    and fails the base rules; repeated rows and null ids keep their own result rows; other columns are not read.
    A row is kept if it passes the base rules and lies in all bands of its script.
    """
    chosen = bands or BANDS

    def judge(batches):
        model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
        byte_ids = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        for batch, block in blocks(batches, text):
            words = block.words()
            hashes = words.hashes()
            base = base_counts(block, words, hashes)
            tokens, fallback, entropy = token_figures(model, block, words, hashes, byte_ids)
            fertility = base["word_chars"] / np.maximum(tokens, 1)
            share = fallback / np.maximum(tokens, 1)
            script = scripts(block)
            low, high, most, least = np.array([chosen[s] for s in script]).T
            failed = (base["n_words"] < min_words) | (100 * base["n_repeat_words"] > repeat_percent * base["n_words"])
            fits = (fertility >= low) & (fertility <= high) & (share <= most) & (
                (entropy >= least) | (tokens < ENTROPY_TOKENS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64()) for v in base.values()), pa.array(script),
                 pa.array(fertility), pa.array(share), pa.array(entropy), pa.array(failed), pa.array(fits & ~failed)],
                ["doc_id", *base, "script", "chars_per_token", "byte_share", "token_entropy", "base_failed", "kept"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(judge, SCHEMA.format(kind))
