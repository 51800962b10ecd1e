"""Language identification by cross-parsing against suffix automata of labelled text.

Each language has a suffix automaton of a bounded sample. A text is parsed greedily into longest matches with each of
them; the language that needs fewest phrases, weighed by the size of its automaton, wins. Many pieces of text are
parsed in step with numpy: one table lookup moves all of them by one symbol.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslake.llm.blocks import Block, blocks, encoded
from opslake.llm.marks import rows_as
from opslake.session import use_text_batches

LETTER = regex.compile(r"\p{L}")
UNKNOWN, BREAK = 1, 2
#: Texts are parsed in pieces of so many symbols, so that long and short ones move together.
PIECE = 512


def byte_symbols(used: set[int]) -> np.ndarray:
    """Symbol of every byte: 0 for ASCII other than letters, then the bytes of the samples; others are unknown."""
    table = np.zeros(256, np.int32)
    table[128:] = UNKNOWN
    for symbol, byte in enumerate(sorted(b for b in used if 97 <= b <= 122 or b >= 128), start=3):
        table[byte] = symbol
    table[[b for b in range(97, 123) if not table[b]]] = UNKNOWN
    return table


def automaton(symbols: list[int], width: int) -> np.ndarray:
    """Transitions of the suffix automaton, state 0 first; -1 where there is none."""
    moves, link, size, last = [{}], [-1], [0], 0
    for s in symbols:
        moves.append({})
        link.append(0)
        size.append(size[last] + 1)
        new, p = len(moves) - 1, last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if size[p] + 1 == size[q]:
                link[new] = q
            else:
                moves.append(dict(moves[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                copy = len(moves) - 1
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    table = np.full((len(moves), width), -1, np.int32)
    for state, out in enumerate(moves):
        table[state, list(out)] = list(out.values())
    return table


@dataclass
class Languages:
    """The automata of all languages in one table, with absolute states."""

    names: list[str]
    bytes_to: np.ndarray
    table: np.ndarray
    width: int
    roots: np.ndarray
    restart: np.ndarray
    price: np.ndarray

    @staticmethod
    def learn(samples: dict[str, list[bytes]], most: int) -> "Languages":
        """``samples``: texts by language, in the order that wins ties; ``most`` symbols of each are taken."""
        names = list(samples)
        bytes_to = byte_symbols({b for texts in samples.values() for t in texts for b in t})
        width = int(bytes_to.max()) + 1 if names else 3
        width = max(width, 3)
        tables, roots, lengths, at = [], [], [], 0
        for name in names:
            symbols: list[int] = []
            for t in samples[name]:
                symbols += [*clean(Block([t]), bytes_to)[0].tolist(), BREAK]
            table = automaton(symbols[:most], width)
            tables.append(np.where(table >= 0, table + at, -1))
            roots.append(at)
            lengths.append(min(len(symbols), most))
            at += len(table)
        stacked = np.concatenate(tables) if tables else np.zeros((0, width), np.int32)
        first = np.array(roots, np.int64)
        restart = np.where(stacked[first] >= 0, stacked[first], first[:, None]).astype(np.int32)
        return Languages(names, bytes_to, stacked.astype(np.int32).ravel(), width, first.astype(np.int32), restart,
                         np.log2(np.array(lengths, float) + 2))

    def phrases(self, symbols: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Phrases of every document by language."""
        many = -(-sizes // PIECE)
        doc = np.repeat(np.arange(len(sizes)), many)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        begin, length = starts[doc] + nth * PIECE, np.minimum(sizes[doc] - nth * PIECE, PIECE)
        order = np.argsort(-length, kind="stable")
        begin, length, doc = begin[order], length[order], doc[order]
        state = np.repeat(self.roots[:, None], len(doc), axis=1)
        count = np.zeros(state.shape, np.int64)
        for step in range(int(length[0]) if len(length) else 0):
            n = np.searchsorted(-length, -step, side="left")
            symbol, now = symbols[begin[:n] + step], state[:, :n]
            move = self.table[now * np.int64(self.width) + symbol]
            broken = move < 0
            count[:, :n] += broken | (now == self.roots[:, None])
            state[:, :n] = np.where(broken, self.restart[:, symbol], move)
        return np.array([np.bincount(doc, weights=c, minlength=len(sizes)) for c in count]).reshape(
            len(self.names), len(sizes))


def clean(block: Block, bytes_to: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols with runs of non-letters as one; starts and sizes of the documents.

    Every document begins after a gap and ends with one.
    """
    symbols = bytes_to[block.data]
    keep = np.ones(len(symbols), bool)
    keep[1:] = (symbols[1:] != 0) | (symbols[:-1] != 0)
    at = np.cumsum(keep)
    end = at[block.ends]
    start = np.append(0, end[:-1])
    # The gap that ends a document is also the one before the next.
    return np.append(np.int32(0), symbols[keep]), start, end - start + 1


def labelled_samples(docs: DataFrame, doc_id: str, text: str, lang: str, rows: int, chars: int
                     ) -> dict[str, list[bytes]]:
    """At most ``rows`` texts of each language (smallest hashes), of each at most ``chars`` characters.

    Lines that two of the texts share are left out, as licences and the like say nothing of a language. Languages come
    in the order of their number of documents.
    """
    usable = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.xxhash64(doc_id, F.lit(3)).alias("h"), F.col(doc_id).alias("k"),
        F.lower(F.substring(F.col(text), 1, chars)).alias("t"))
    order = Window.partitionBy("lang").orderBy("h", "k", "t")
    picked = usable.withColumn("n", F.row_number().over(order)).where(F.col("n") <= rows)
    out: dict[str, list[bytes]] = {
        r.lang: [] for r in usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()}
    table = picked.orderBy("lang", "n").toArrow()
    texts = encoded(table["t"].combine_chunks())
    seen = Counter(line for t in texts for line in set(t.split(b"\n")))
    for name, t in zip(table["lang"].to_pylist(), texts):
        out[name].append(b"\n".join(line for line in t.split(b"\n") if seen[line] == 1))
    return out


def identify(docs: DataFrame, train_docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
             sample_rows: int = 60, sample_chars: int = 1_200, sample_symbols: int = 20_000) -> DataFrame:
    """doc_id, lang_pred, score, phrase_rate for every whole text of ``docs``.

    ``train_docs`` gives text and label; the number of labels is taken to be small, and ``sample_symbols`` of each are
    learned. ``score`` is the winner's share under exp(-20 * rate); ``phrase_rate`` is its weighed phrases a symbol.
    A null text, one without a letter, and any text when there are no labels are ``und`` with score 0 and no rate.
    Ties go to the language with more documents. Repeated rows and null ids are kept; other columns are not read.
    """
    use_text_batches(docs.sparkSession)
    known = Languages.learn(labelled_samples(train_docs, doc_id, text, lang, sample_rows, sample_chars), sample_symbols)
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def predict(batches):
        langs: Languages = shared.value
        for batch, block in blocks(batches, text):
            texts = [t.decode("utf-8", "replace") for t in block.texts]
            letters = np.array([LETTER.search(t) is not None for t in texts]) & bool(langs.names)
            lowered = Block([t.lower().encode() for t in texts])
            symbols, starts, sizes = clean(lowered, langs.bytes_to)
            if langs.names:
                rate = langs.phrases(symbols, starts, sizes) * langs.price[:, None] / sizes
                best = np.argmin(rate, axis=0)
                least = rate[best, np.arange(len(texts))]
                score = 1 / np.exp(-20 * (rate - least)).sum(axis=0)
            else:
                best, least, score = (np.zeros(len(texts), int) for _ in range(3))
            named = [langs.names[b] if ok else "und" for b, ok in zip(best, letters)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(named, pa.string()), pa.array(np.where(letters, score, 0.0)),
                 pa.array(least.astype(float), mask=~letters)], ["doc_id", "lang_pred", "score", "phrase_rate"])

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id), F.col(text)).mapInArrow(
        predict, f"doc_id {kind}, lang_pred string, score double, phrase_rate double")


def keep_languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang",
                   most_rate: float = 8.0, **options) -> DataFrame:
    """The rows of ``docs`` whose text is in a language, with all columns.

    Learns from the labels of ``docs`` themselves. A text is rejected if it is ``und``, or if even its own language needs
    more than ``most_rate`` weighed phrases a symbol, which is less than two symbols a phrase. Without any label only
    texts without letters are ``und`` to reject, and all others stay.
    """
    whole = rows_as(docs, "_row").select("_row", F.col(text).alias("_text"), F.col(lang).alias("_lang"))
    found = identify(whole, whole, "_row", "_text", "_lang", **options)
    letters = F.coalesce(F.col(f"doc_id.`{text}`").rlike(r"\p{L}"), F.lit(False))
    stays = (F.col("lang_pred") != "und") & (F.col("phrase_rate") <= most_rate)
    unlabelled = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).isEmpty()
    return found.where(letters if unlabelled else stays).select("doc_id.*")
