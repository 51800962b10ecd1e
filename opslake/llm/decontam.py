"""Benchmark decontamination by templates: numbers, units and names become typed slots.

Native expressions only. Windows of template words are joined by hash; where one meets, the values in its slots are
compared by their pattern of equality, so that a question asked again with other numbers or names is found if it renames
them consistently, and only then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.llm.marks import keyed, rows_as
from opslake.session import use_shared_checkpoints

#: Units that may follow a number.
UNITS = ("km m cm mm kg g mg l ml s ms h min hours hour minutes minute seconds second days day weeks week months month "
         "years year miles mile meters meter metres metre grams gram liters litres dollars euros cents percent degrees")
#: A private-use character marks a slot; its type follows: n, u or p for number, unit or name.
MARK = "\ue000"
#: A table of more windows than this is joined by a shuffle and not shared; one window takes some 24 bytes.
SHARED_WINDOWS = 1_000_000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, though it stands in several places or in a lambda."""
    return F.element_at(F.transform(F.array(value), use), 1)


def slotted(text: Column) -> Column:
    """Lower-case words without punctuation; those that fill a slot keep their value behind a mark.

    A number is a word with a digit; a unit is one of UNITS right after a number; a name is a capitalised word that does
    not begin the text or follow a full stop, exclamation mark, question mark or colon.
    """
    def numbers(flat: Column) -> Column:
        numbered = F.regexp_replace(flat, r"(?<![^ ])(?=[^ 0-9]*+[0-9])", MARK + "n")
        units = F.regexp_replace(numbered, rf"({MARK}n[^ ]* )({UNITS.replace(' ', '|')})(?![\p{{L}}\p{{N}}])",
                                 "$1" + MARK + "u$2")
        return F.when(flat.rlike("[0-9]"), units).otherwise(flat)

    flat = F.trim(F.regexp_replace(F.replace(text, F.lit(MARK), F.lit("")), r"\s+", " "))
    named = F.regexp_replace(let(flat, numbers), r"(?<=[^ .!?:] )(?=\p{Lu}\p{Ll})", MARK + "p")
    return F.trim(F.regexp_replace(F.lower(named), rf"[^\p{{L}}\p{{N}}{MARK} ]+", ""))


def tokens(slots: Column) -> Column:
    return F.filter(F.split(slots, " +"), lambda x: x != "")


def template(slots: Column) -> Column:
    """The slotted text with bare slots."""
    return F.when(F.contains(slots, F.lit(MARK)), F.regexp_replace(slots, MARK + "([nup])[^ ]*", MARK + "$1")).otherwise(
        slots)


def word_hashes(slots: Column) -> Column:
    return F.transform(tokens(let(slots, template)), lambda x: F.xxhash64(x))


def windows(slots: Column, size: int) -> Column:
    """Hash of every window of template words, in order."""
    def roll(hashes: Column) -> Column:
        last = F.size(hashes) - size + 1
        places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.xxhash64(F.slice(hashes, i, size)))

    return let(word_hashes(slots), roll)


def pattern(window: Column) -> Column:
    """Where the value of each slot of a window stood first; equal for consistent renamings."""
    values = F.filter(window, lambda x: F.startswith(x, F.lit(MARK)))
    return let(values, lambda v: F.transform(v, lambda x: F.array_position(v, x)))


def questions(benchmark: DataFrame, window: int, least_literal: float, item_id: str, text: str) -> DataFrame:
    """size, hash, pattern, item: distinct windows of the benchmark with the smallest item that has each.

    An item of fewer words than a window is one window of its own length. Windows with too few literal words are left out,
    as slots alone identify nothing.
    """
    words = benchmark.select(F.col(item_id).alias("item"), slotted(F.col(text)).alias("slots"))
    words = words.withColumn("words", tokens(F.col("slots"))).where(F.size("words") > 0)
    words = words.withColumn("size", F.least(F.size("words"), F.lit(window)))
    rows = words.withColumn("hashes", word_hashes(F.col("slots"))).withColumn("i", F.explode(F.expr("sequence(1, size(words) - size + 1)")))
    part = F.slice("words", F.col("i"), F.col("size"))
    literal = F.size(F.filter(part, lambda x: ~F.startswith(x, F.lit(MARK))))
    return rows.where(literal >= F.col("size") * least_literal).select(
        "size", F.xxhash64(F.slice("hashes", F.col("i"), F.col("size"))).alias("hash"), pattern(part).alias("pattern"),
        "item").groupBy("size", "hash", "pattern").agg(F.min("item").alias("item"))


def small(df: DataFrame, windows_of: Column | None = None) -> DataFrame:
    """The stored frame, marked to be shared if its counted windows (or rows) allow it."""
    total = df.agg(F.sum(F.lit(1) if windows_of is None else windows_of)).first()[0] or 0
    return F.broadcast(df) if total <= SHARED_WINDOWS else df


def matches(named: DataFrame, benchmark: DataFrame, window: int, least_literal: float, item_id: str, item_text: str
            ) -> DataFrame:
    """k, h, n, item of the keyed documents with a matching window."""
    use_shared_checkpoints(named.sparkSession)
    asked = questions(benchmark, window, least_literal, item_id, item_text).checkpoint()
    # At most one size for each length up to the window's.
    sizes = [r["size"] for r in asked.select("size").distinct().collect()] or [window]
    slots = named.select("k", "h", slotted(F.col("text")).alias("slots"))
    known = small(asked.select("size", "hash").distinct())
    found = None
    for size in sorted(sizes):
        rows = slots.select("k", "h", F.posexplode(windows(F.col("slots"), size)).alias("place", "hash"))
        met = rows.join(known.where(F.col("size") == size), "hash").select("k", "h", "size", "place", "hash")
        found = met if found is None else found.unionByName(met)
    met = found.groupBy("k", "h").agg(F.collect_set(F.struct("size", "place", "hash")).alias("met")).checkpoint()
    words = slots.join(small(met, F.size("met")), ["k", "h"]).withColumn("words", tokens(F.col("slots"))).dropDuplicates(["k", "h"])
    checked = words.select("k", "h", F.explode(let(F.col("words"), lambda w: F.transform("met", lambda m: F.struct(
        m["size"].alias("size"), m["hash"].alias("hash"), m["place"].alias("place"),
        pattern(F.slice(w, m["place"] + 1, m["size"])).alias("pattern"))))).alias("m"))
    return checked.select("k", "h", "m.*").join(asked, ["size", "hash", "pattern"]).groupBy("k", "h").agg(
        F.count("*").alias("n"), F.min("item").alias("item")).checkpoint()


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, least_literal: float = 0.5,
                 doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
                 ) -> DataFrame:
    """doc_id, n_windows, item_id, contaminated of every row.

    ``n_windows`` counts the windows of a document that match a benchmark window in template and slot pattern, ``item_id``
    is the smallest item among them. A null or empty text has no window and is clean, as is everything against an empty
    benchmark; null and empty items are ignored; of repeated items the smallest id is named. Repeated rows and null ids
    are kept. Other columns are not read.
    """
    named = keyed(docs, doc_id, text)
    agreed = matches(named, benchmark, window, least_literal, item_id, item_text)
    return named.select("k", "h", "doc_id").join(small(agreed), ["k", "h"], "left").select(
        "doc_id", F.coalesce("n", F.lit(0)).cast("bigint").alias("n_windows"), F.col("item").alias("item_id"),
        F.col("n").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 13, least_literal: float = 0.5,
                      doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
                      ) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all columns."""
    named = keyed(rows_as(docs, "_row"), doc_id, text, "_row")
    agreed = matches(named, benchmark, window, least_literal, item_id, item_text)
    return named.select("k", "h", "_row").join(small(agreed.select("k", "h")), ["k", "h"], "left_anti").select("_row.*")


#: The same result in DuckDB SQL, word by word.
SQL = rf"""
WITH texts AS (
    SELECT doc_id AS id, text, TRUE AS is_doc FROM documents UNION ALL SELECT item_id, text, FALSE FROM benchmark),
raw AS (
    SELECT id, is_doc, row_number() OVER () AS row_id, list_filter(regexp_split_to_array(
        trim(regexp_replace(replace(coalesce(text, ''), '{MARK}', ''), '\s+', ' ', 'g')), ' '), lambda x: x <> '') AS w
    FROM texts),
slots AS (
    SELECT id, is_doc, row_id, list_filter(list_transform(w, lambda x, i: CASE
            WHEN regexp_matches(x, '[0-9]') THEN '{MARK}n'
            WHEN i > 1 AND regexp_matches(w[i - 1], '[0-9]')
                 AND regexp_matches(x, '^({UNITS.replace(' ', '|')})([^\p{{L}}\p{{N}}]|$)') THEN '{MARK}u'
            WHEN i > 1 AND regexp_matches(x, '^\p{{Lu}}\p{{Ll}}') AND NOT regexp_matches(w[i - 1], '[.!?:]$')
                 THEN '{MARK}p' ELSE '' END || regexp_replace(lower(x), '[^\p{{L}}\p{{N}}]+', '', 'g')), lambda x: x <> '') AS w
    FROM raw),
items AS (
    SELECT id AS item, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i, w, n
    FROM (SELECT *, least(len(w), 13) AS n FROM slots WHERE NOT is_doc AND len(w) > 0)),
asked AS (SELECT DISTINCT item, n, list_transform(p, lambda x: CASE WHEN x[1] = '{MARK}' THEN x[1:2] ELSE x END) AS t, p
    FROM (SELECT item, n, w[i:i + n - 1] AS p FROM items)
    WHERE len(list_filter(p, lambda x: x[1] <> '{MARK}')) >= n * 0.5),
asked_patterns AS (SELECT item, n, t, list_transform(list_filter(p, lambda x: x[1] = '{MARK}'),
    lambda x: list_position(list_filter(p, lambda y: y[1] = '{MARK}'), x)) AS q FROM asked),
places AS (
    SELECT id, row_id, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i, w
    FROM slots, (SELECT DISTINCT n FROM asked) WHERE is_doc AND len(w) >= n),
held AS (SELECT id, row_id, i, n, list_transform(p, lambda x: CASE WHEN x[1] = '{MARK}' THEN x[1:2] ELSE x END) AS t, p
    FROM (SELECT id, row_id, i, n, w[i:i + n - 1] AS p FROM places)),
hits AS (SELECT DISTINCT h.row_id, h.i, h.n, a.item FROM held h JOIN asked_patterns a ON a.n = h.n AND a.t = h.t
    AND a.q = list_transform(list_filter(h.p, lambda x: x[1] = '{MARK}'),
        lambda x: list_position(list_filter(h.p, lambda y: y[1] = '{MARK}'), x)))
SELECT s.id AS doc_id, count(DISTINCT (h.i, h.n)) FILTER (WHERE h.i IS NOT NULL) AS n_windows, min(h.item) AS item_id,
       count(h.i) > 0 AS contaminated
FROM slots s LEFT JOIN hits h USING (row_id) WHERE s.is_doc GROUP BY s.row_id, s.id
"""
