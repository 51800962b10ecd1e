"""Groups of labels that differ by a few letters.

Similarity is round(100 * (1 - edit distance / longer length)); two labels match at the
threshold or above, and matches are closed into groups under the smallest label.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake.session import use_shared_checkpoints


def similarity(a: Column, b: Column) -> Column:
    longer = F.greatest(F.length(a), F.length(b))
    return F.round(F.lit(100.0) * (F.lit(1.0) - F.levenshtein(a, b) / longer)).cast("int")


# Labels allowing up to this many edits are matched through their deletions, longer ones through pieces.
DELETED = 2


def similar_pairs(labels: DataFrame, threshold: int = 90) -> DataFrame:
    """All pairs (a < b) of distinct labels at or above the threshold, without comparing all pairs.

    Exact: candidates are complete on either path, and every one is verified.
    """
    slack = (100.5 - threshold) / 100.0
    named = labels.select(F.col("label")).where(F.length("label") > 0).distinct().withColumn("n", F.length("label"))
    # Few bytes of labels turn into many candidate keys, so they stay spread over all cores.
    named = named.repartition(labels.sparkSession.sparkContext.defaultParallelism, "label")
    met = _meet_by_deletions(named, slack).unionByName(_meet_by_pieces(named, slack))
    pairs = met.select(F.least("l", "s").alias("a"), F.greatest("l", "s").alias("b")).distinct()
    return pairs.withColumn("score", similarity(F.col("a"), F.col("b"))).where(F.col("score") >= threshold)


def _edits(length: Column, slack: float) -> Column:
    """Edits a pair may differ by when its longer label has this length."""
    return F.floor(length * F.lit(slack) + F.lit(1e-9)).cast("int")


def _longest_partner(length: Column, slack: float) -> Column:
    return F.floor(length / F.lit(1.0 - slack) + F.lit(1e-9)).cast("int")


def _meet_by_deletions(named: DataFrame, slack: float) -> DataFrame:
    """Two labels k edits apart become equal after deleting at most k letters from each.

    The meeting key is nearly the whole label, so labels made from one template ("Item 0001", ...)
    do not all meet on their common part.
    """
    def shorter(text: Column) -> Column:
        places = F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.concat(
            F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))

    eligible = named.where((_edits(F.col("n"), slack) <= DELETED) & (_edits(_longest_partner(F.col("n"), slack), slack) > 0))
    once = shorter(F.col("label"))
    forms = F.array_distinct(F.concat(F.array("label"), once, F.flatten(F.transform(once, lambda t: shorter(t)))))
    held = eligible.select("label", F.explode_outer(forms).alias("form"))
    return held.select(F.col("label").alias("l"), "form").join(
        held.select(F.col("label").alias("s"), "form"), "form").where(F.col("l") < F.col("s")).select("l", "s")


def _meet_by_pieces(named: DataFrame, slack: float) -> DataFrame:
    """Cut the longer label into one piece more than the edits allowed: an edit touches one piece, so
    some piece survives unchanged in the shorter label, moved by at most the allowed edits. Labels
    meet on (longer length, piece number, piece text).
    """
    def edits(length: Column) -> Column:
        return _edits(length, slack)

    def start(length: Column, piece: Column) -> Column:
        return F.floor(length * piece / (edits(length) + 1)).cast("int")

    pieces = F.transform(F.sequence(F.lit(0), edits(F.col("n"))), lambda i: F.struct(
        i.alias("piece"),
        F.substring("label", start(F.col("n"), i) + 1, start(F.col("n"), i + 1) - start(F.col("n"), i)).alias("part")))
    longer = named.where(edits(F.col("n")) > DELETED).select(
        F.col("label").alias("l"), F.col("n").alias("ln"), F.inline(pieces))

    # A shorter label is looked up for every length that may still match it.
    lengths = F.sequence(F.col("n"), _longest_partner(F.col("n"), slack))
    sized = named.select(F.col("label").alias("s"), "n", F.explode(lengths).alias("ln")).where(
        (edits(F.col("ln")) > DELETED) & (F.col("ln") - F.col("n") <= edits(F.col("ln"))))
    numbered = sized.select("s", "n", "ln", F.explode(F.sequence(F.lit(0), edits(F.col("ln")))).alias("piece")).select(
        "s", "n", "ln", "piece", start(F.col("ln"), F.col("piece")).alias("at"),
        (start(F.col("ln"), F.col("piece") + 1) - start(F.col("ln"), F.col("piece"))).alias("width"))
    placed = numbered.select("s", "n", "ln", "piece", "width", F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("at") - edits(F.col("ln"))),
        F.greatest(F.lit(0), F.least(F.col("n") - F.col("width"), F.col("at") + edits(F.col("ln")))))).alias("at"))
    shorter = placed.where(F.col("at") + F.col("width") <= F.col("n")).select(
        "s", "ln", "piece", F.substring("s", F.col("at") + 1, F.col("width")).alias("part")).distinct()
    return longer.join(shorter, ["ln", "piece", "part"]).where(F.col("l") != F.col("s")).select("l", "s")


def connected(labels: DataFrame, pairs: DataFrame) -> DataFrame:
    """(label, representative): the smallest label reachable through pairs.

    Each round takes the smallest representative among the neighbours and then that one's own
    representative, so distances halve, until nothing changes. Every round is cut off with a checkpoint in shared storage.
    """
    use_shared_checkpoints(labels.sparkSession)
    links = pairs.select(F.col("a").alias("label"), F.col("b").alias("other")).unionByName(
        pairs.select(F.col("b").alias("label"), F.col("a").alias("other"))).checkpoint()
    current = labels.select("label").distinct().withColumn("representative", F.col("label")).checkpoint()
    while True:
        seen = links.join(current.withColumnRenamed("label", "other"), "other").groupBy("label").agg(
            F.min("representative").alias("near"))
        lowered = current.join(seen, "label", "left").select(
            "label", F.least("representative", F.coalesce("near", "representative")).alias("representative"),
            F.col("representative").alias("before"))
        jump = lowered.select(F.col("label").alias("representative"), F.col("representative").alias("further"))
        moved = lowered.join(jump, "representative", "left").select(
            "label", F.least("representative", F.coalesce("further", "representative")).alias("representative"), "before"
        ).checkpoint()
        current = moved.select("label", "representative")
        if moved.where("representative <> before").isEmpty():
            return current


def fuzzy_groups(labels: DataFrame, threshold: int = 90) -> DataFrame:
    """Every distinct label with its representative and its similarity to it."""
    grouped = connected(labels, similar_pairs(labels, threshold))
    return grouped.withColumn("score", similarity(F.col("label"), F.col("representative")))
