"""Near-duplicate documents: an exact set-similarity self-join over word shingles.

A text is the set of its windows of a few words. Two texts match when their sets' Jaccard similarity reaches the threshold,
and matches are closed into groups under the smallest id. A set lacks at most n - ceil(threshold * n) shingles in a match, so
it meets its matches on any part of all shingles of which it holds more than that: the part is a range of hashes, and the
few sets that hold too little of it meet each other on all their shingles as well. The shingles of a part have one order, the
rarest first; of two matching sets the first shared shingle is among the first n - ceil(threshold * n) + 1 of both, so only
those meet. Whole sets are made again from the texts, and only for those that met.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslake.functions import text as tx
from opslake.operators.fuzzy import connected
from opslake.operators.hot import lookup, pairs_by_key
from opslake.session import shared_dir, use_shared_checkpoints

#: Keeps products such as 0.8 * 15 from being rounded up.
NUDGE = 1e-9

#: Sets meet on a part of all shingles that is so many times the share which a match may lack.
PART = 2.0


def shingle_sets(docs: DataFrame, size: int, doc_id: str, text: str) -> DataFrame:
    """doc_id, x, y, n, shingles: the sorted distinct hashes of all windows of ``size`` lower-case words.

    A text with fewer words is one shingle, one without words none. x and y are hashes of the whole set. A filter on these
    columns would be moved below the windows and cut the text once for each of them; filter after the next shuffle.
    """
    cut = docs.select(F.col(doc_id).alias("doc_id"), tx.words(F.lower(F.coalesce(F.col(text), F.lit("")))).alias("_w"))
    n = F.size("_w")
    windows = F.when(n == 0, F.array().cast("array<bigint>")).when(n < size, F.array(F.xxhash64("_w"))).otherwise(
        F.transform(F.sequence(F.lit(0), n - size), lambda i: F.xxhash64(F.slice("_w", i + 1, size))))
    return cut.select("doc_id", F.sort_array(F.array_distinct(windows)).alias("shingles")).select(
        "doc_id", F.xxhash64("shingles").alias("x"), F.xxhash64(F.lit(1), "shingles").alias("y"),
        F.size("shingles").alias("n"), "shingles")


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read from there: narrower than a checkpoint, and of known size."""
    path = shared_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def lacking(n: Column, threshold: float) -> Column:
    """Shingles of a set of this size that a match may lack."""
    return n - F.ceil(F.lit(threshold) * n - NUDGE)


def meeting_lists(sets: DataFrame, threshold: float) -> DataFrame:
    """row, doc_id, x, y, n, lists: the shingles on which a set may meet others, as structs of their number m and keys.

    The first list is the set's part of the shingles that all sets have in common as a meeting place. A set that holds no more
    of it than a match may lack has a second list: all its shingles, under keys of their own. Of two matching sets
    one holds more than that, and they meet on the part, or neither does, and they meet on the second lists.
    """
    share = min(1.0, PART * (1 - threshold))
    bound = min(round(share * 2.0 ** 64) - 2 ** 63, 2 ** 63 - 1)
    cut = sets.withColumn("part", F.filter("shingles", lambda s: s <= F.lit(bound))).withColumn("m", F.size("part"))
    first = F.struct("m", F.col("part").alias("keys"))
    second = F.struct(F.col("n").alias("m"), F.transform("shingles", lambda s: F.xxhash64(s)).alias("keys"))
    short = F.col("m") <= lacking(F.col("n"), threshold)
    return cut.select(F.monotonically_increasing_id().alias("row"), "doc_id", "x", "y", "n",
                      F.when(short, F.array(first, second)).otherwise(F.array(first)).alias("lists"))


def distinct_sets(cut: DataFrame) -> tuple[DataFrame, DataFrame]:
    """x, y, held, n, node of each set, held by so many documents, node being the smallest; and node, n, lists of the same sets."""
    light = cut.select("row", "doc_id", "x", "y", "n")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("first")
    nodes = stored(light.groupBy("x", "y").agg(first, F.count("*").alias("held"), F.any_value("n").alias("n")).select(
        "x", "y", "held", "n", F.col("first.doc_id").alias("node"), F.col("first.row").alias("row")), "nodes")
    several = nodes.where("held > 1").select("x", "y", "held", F.col("row").alias("_first"))
    copies = stored(lookup(light.select("row", "x", "y"), several, ["x", "y"]).where("row <> _first").select("row"), "copies")
    return nodes.drop("row"), cut.join(copies, "row", "left_anti").select(F.col("doc_id").alias("node"), "n", "lists")


def least_overlap(n: Column, m: Column, threshold: float) -> Column:
    """Shingles that sets of these sizes must share to match."""
    return F.ceil(F.lit(threshold / (1 + threshold)) * (n + m) - NUDGE)


def prefixes(parts: DataFrame, threshold: float) -> DataFrame:
    """s, node, n, m, place: the leading shared keys of every list, rarest first, with their places in the list."""
    held = parts.select("node", "n", F.inline("lists")).select("node", "n", "m", F.explode("keys").alias("s"))
    # A key of one set meets nothing. Such keys come first in every order, so only their number matters.
    shared = stored(held.groupBy("s").agg(F.count("*").alias("held")).where("held > 1"), "shared")
    counted = lookup(held, shared.withColumn("df", F.col("held")), ["s"])
    own = Window.partitionBy("node", "m")  # a second list is longer than the first
    place = F.col("m") - F.count("*").over(own) + F.row_number().over(own.orderBy("df", "s")) - 1
    return counted.select("s", "node", "n", "m", place.cast("int").alias("place")).where(
        F.col("place") <= lacking(F.col("n"), threshold))


def may_match(l: str, r: str, threshold: float) -> Column:
    """Length and position filter at a shared key, which is sure to hold at the first one that two matching sets share."""
    n, m = F.col(f"{l}.n"), F.col(f"{r}.n")
    left = F.least(F.col(f"{l}.m") - F.col(f"{l}.place"), F.col(f"{r}.m") - F.col(f"{r}.place"))
    beside = F.least(n - F.col(f"{l}.m"), m - F.col(f"{r}.m"))
    return (F.least(n, m) >= F.greatest(n, m) * threshold - NUDGE) & (left + beside >= least_overlap(n, m, threshold))


def ends(pairs: DataFrame) -> DataFrame:
    """The nodes of the pairs, each once."""
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def similarities(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, score: the Jaccard similarity of the sets of both nodes."""
    sets = nodes.select("node", "n", "shingles")
    both = pairs.join(sets.toDF("b", "n_b", "set_b"), "b").join(sets.toDF("a", "n_a", "set_a"), "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return both.select("a", "b", (shared / (F.col("n_a") + F.col("n_b") - shared)).alias("score"))


def group_links(parts: DataFrame, whole: Callable[[DataFrame], DataFrame], threshold: float
                ) -> tuple[DataFrame, DataFrame, DataFrame]:
    """label, representative: the smallest node of the group of every node whose leading keys meet another's.

    First every posting is compared with its smallest node only, which settles groups of versions of one text at the cost
    of their size. Then all pairs that meet and are not in one group yet are compared, so nothing is left out. ``whole``
    gives the sets of nodes. The links found (a, b, score) and the sets of all that met come along.
    """
    postings = stored(prefixes(parts, threshold), "postings")
    leaders = stored(postings.groupBy("s").agg(F.min(F.struct("node", "n", "m", "place")).alias("lead"), F.count("*").alias("held")).where(
        "held > 1"), "leaders")
    row = F.struct("node", "n", "m", "place").alias("row")
    met = lookup(postings, leaders, ["s"]).select("lead", row)
    first = stored(met.where((F.col("lead.node") != F.col("row.node")) & may_match("lead", "row", threshold)).select(
        F.col("lead.node").alias("a"), F.col("row.node").alias("b")).distinct(), "first")
    asked = stored(ends(first), "asked")
    sets = whole(asked)
    links = stored(similarities(first, sets).where(F.col("score") >= threshold), "links")
    groups = connected(postings.select(F.col("node").alias("label")), links)
    named = stored(postings.join(groups.withColumnRenamed("label", "node"), "node"), "named")
    open_ = stored(named.groupBy("s").agg(F.min("representative").alias("_least"), F.max("representative").alias("_most"),
                                          F.count("*").alias("held")).where("_least < _most").select("s", "held"), "open")
    apart = (F.col("l.representative") != F.col("r.representative")) & (F.col("l.node") < F.col("r.node"))
    rest = stored(pairs_by_key(named, open_, "s", apart & may_match("l", "r", threshold)).select(
        F.col("l.node").alias("a"), F.col("r.node").alias("b"), F.col("l.representative").alias("p"),
        F.col("r.representative").alias("q")).distinct().join(first, ["a", "b"], "left_anti"), "rest")
    sets = sets.unionByName(whole(stored(ends(rest).join(asked, "node", "left_anti"), "more")))
    more = stored(similarities(rest.select("a", "b"), sets).where(F.col("score") >= threshold).join(rest, ["a", "b"]), "links")
    joined = connected(groups.select(F.col("representative").alias("label")), more.select(F.col("p").alias("a"), F.col("q").alias("b")))
    found = groups.join(joined.toDF("representative", "_root"), "representative").select("label", F.col("_root").alias("representative"))
    return found, links.unionByName(more.select("a", "b", "score")), sets


def near_duplicates(docs: DataFrame, size: int = 5, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text"
                    ) -> DataFrame:
    """doc_id, representative, score: the smallest id of each document's group and the similarity to that document.

    Groups are closed over all pairs of texts at or above the threshold; none is left out. Documents with one set of
    shingles are compared once. A document without words is a group of its own, with score 1. ``doc_id`` is the key of the
    documents. Shingles are 64-bit hashes, sets are told apart by 128 bits.
    """
    use_shared_checkpoints(docs.sparkSession)

    def whole(wanted: DataFrame) -> DataFrame:
        told = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(
            wanted.withColumnRenamed("node", "doc_id"), "doc_id", "left_semi")
        return stored(shingle_sets(told, size, "doc_id", "text").dropDuplicates(["doc_id", "x", "y"]).select(
            F.col("doc_id").alias("node"), "n", "shingles"), "sets")

    cut = stored(meeting_lists(shingle_sets(docs, size, doc_id, text), threshold), "cut")
    nodes, parts = distinct_sets(cut)
    groups, links, sets = group_links(parts, whole, threshold)
    known = nodes.join(groups.withColumnRenamed("label", "node"), "node", "left").withColumn(
        "representative", F.when(F.col("n") > 0, F.coalesce("representative", "node")))
    far = known.where("node <> representative").select(F.col("representative").alias("a"), F.col("node").alias("b")).join(
        links.groupBy("a", "b").agg(F.max("score").alias("score")), ["a", "b"], "left")
    far = stored(far, "far")
    # Whoever is linked to its representative has its score already.
    scores = far.where("score IS NOT NULL").unionByName(similarities(stored(far.where("score IS NULL").select("a", "b"), "unscored"), sets))
    scored = stored(known.join(scores.select(F.col("b").alias("node"), "score"), "node", "left").select(
        "x", "y", "held", "representative", F.coalesce("score", F.lit(1.0)).alias("score")), "scored")
    # The set without shingles has no representative: each of its documents stands alone.
    return lookup(cut.select("doc_id", "x", "y"), scored, ["x", "y"]).select(
        "doc_id", F.coalesce("representative", "doc_id").alias("representative"), "score")
