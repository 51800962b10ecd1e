"""Conversation history, quotas, session events, caches and nested documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslake import schemas
from opslake.functions.quantiles import exact_quantiles
from opslake.operators.ordered import running, time_slice, top_per_key
from opslake.operators.telemetry import moment

# History length, idle limit, daily quota and its zone.
HISTORY_LENGTH = 50
IDLE_SECONDS = 3600
DAILY_QUOTA = 10
QUOTA_ZONE = "Asia/Baku"


def last_messages(messages: DataFrame, n: int = HISTORY_LENGTH) -> DataFrame:
    return top_per_key(messages, ["session_id"], [F.col("turn").desc()], n)


def live_sessions(messages: DataFrame, as_of: str, ttl_seconds: int = IDLE_SECONDS) -> DataFrame:
    """Messages of the sessions whose last message is no older than the limit."""
    last = messages.groupBy("session_id").agg(F.max("created_at").alias("_last"))
    alive = last.where(F.unix_micros(moment(as_of)) - F.unix_micros("_last") <= ttl_seconds * 1_000_000)
    return messages.join(alive.select("session_id"), "session_id", "left_semi")


def messages_after(messages: DataFrame, after: DataFrame, limit: int = 20) -> DataFrame:
    """Per conversation the first messages after a given one; without one, from the start."""
    cursor = after.select(F.col("session_id"), F.col("after_turn"))
    later = messages.join(cursor, "session_id", "left").where(
        F.col("after_turn").isNull() | (F.col("turn") > F.col("after_turn"))).drop("after_turn")
    return top_per_key(later, ["session_id"], [F.col("turn")], limit)


def daily_quota(requests: DataFrame, limit: int = DAILY_QUOTA, zone: str = QUOTA_ZONE) -> DataFrame:
    """Admit the first requests of every user and local day and reject the rest.

    Only admitted rows need a number, and those are found with a limit before the shuffle. The
    rest come back through a join on the request id, which has no hot values.
    """
    local = requests.withColumn("local_day", F.to_date(F.from_utc_timestamp("ts", zone)))
    first = top_per_key(local.select("request_id", "user", "local_day", "ts"), ["user", "local_day"],
                        [F.col("ts"), F.col("request_id")], limit, rank="number")
    return local.select("request_id", "user", "local_day", "ts").join(
        first.select("request_id", "number"), "request_id", "left"
    ).select("request_id", "user", "local_day", "ts",
             F.col("number").isNotNull().alias("admitted"),
             F.coalesce(F.lit(limit) - F.col("number"), F.lit(0)).alias("remaining"),
             F.date_add("local_day", 1).alias("reset_day"))


def event_sequence(events: DataFrame, session: str, time: str, tie: str, slice_seconds: int = 900) -> DataFrame:
    """Number of every event within its session, counted slice by slice."""
    sliced = events.withColumn("_at", time_slice(F.col(time), slice_seconds))
    return running(sliced, [session], [time, tie], "_at", {"sequence_id": ("count", None)}).drop("_at")


def session_events(events: DataFrame, session: str, session_id) -> DataFrame:
    return events.where(F.col(session) == F.lit(session_id))


def stage_latency(events: DataFrame) -> DataFrame:
    """Statistics of stage durations from the JSON payload of timing events."""
    timing = events.where("event_type = 'timing'").select(
        F.from_json("payload", schemas.TIMING_PAYLOAD).alias("p")).select("p.stage", F.col("p.duration_ms").alias("ms"))
    basics = timing.groupBy("stage").agg(
        F.count("ms").alias("turns"), F.avg("ms").alias("avg_ms"), F.max("ms").alias("max_ms"))
    return basics.join(exact_quantiles(timing, ["stage"], F.col("ms"), {"p50_ms": 0.5, "p99_ms": 0.99}), "stage", "left")


def compare_backends(runs: DataFrame) -> DataFrame:
    """One row per prompt that both backends ran; equal latency counts for backend b.

    Rows of the two backends meet in one aggregate with one row per prompt, not in a self-join.
    """
    def of(backend: str, column: str, name: str) -> Column:
        return F.max(F.when(F.col("backend") == backend, F.col(column))).alias(name)

    pairs = runs.groupBy("prompt_id").agg(
        of("a", "latency_ms", "latency_a_ms"), of("b", "latency_ms", "latency_b_ms"),
        of("a", "failed", "failed_a"), of("b", "failed", "failed_b")
    ).where("latency_a_ms IS NOT NULL AND latency_b_ms IS NOT NULL")
    return pairs.select(
        "prompt_id", "latency_a_ms", "latency_b_ms",
        F.round(F.abs(F.col("latency_a_ms") - F.col("latency_b_ms")), 2).alias("latency_diff_ms"),
        F.when(F.col("latency_a_ms") < F.col("latency_b_ms"), "a").otherwise("b").alias("faster"),
        (~F.col("failed_a") & ~F.col("failed_b")).alias("both_succeeded"), "failed_a", "failed_b")


def comparison_summary(pairs: DataFrame) -> DataFrame:
    def mean(side: str) -> Column:
        ok = F.avg(F.when(~F.col(f"failed_{side}"), F.col(f"latency_{side}_ms")))
        return F.coalesce(F.round(ok, 2), F.lit(0.0)).alias(f"avg_latency_{side}_ms")

    return pairs.agg(F.count(F.lit(1)).alias("total_requests"), F.count_if("both_succeeded").alias("both_succeeded"),
                     mean("a"), mean("b"), F.count_if(F.col("faster") == "a").alias("faster_a"))


def append_new_only(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``new`` whose keys are not in ``existing`` yet."""
    return new.join(existing.select(*keys).distinct(), keys, "left_anti")


def cache_lookup(requests: DataFrame, cache: DataFrame) -> DataFrame:
    """Requests with the stored response of the same prompt; ``hit`` is false for the rest.

    A prompt stored more than once answers with its smallest response, so a request stays one row.

    The join key is a hash of the prompt, so long prompts are not compared byte by byte in the
    shuffle; the prompt itself is compared as well.
    """
    stored = cache.groupBy(F.sha2("prompt", 256).alias("_h"), F.col("prompt").alias("_p")).agg(
        F.min("response").alias("response"))
    asked = requests.withColumn("_hash", F.sha2("prompt", 256))
    return asked.join(stored, (F.col("_hash") == F.col("_h")) & (F.col("prompt") == F.col("_p")), "left").withColumn(
        "hit", F.col("_p").isNotNull()).drop("_hash", "_h", "_p")


def nest_documents(documents: DataFrame, chunks: DataFrame, embeddings: DataFrame, document_tags: DataFrame,
                   tags: DataFrame) -> DataFrame:
    """Documents with their chunks, each with its vector, and their tags; empty lists when none.

    Chunks of one document and its tags are bounded by the document itself.
    """
    with_vectors = chunks.join(embeddings, "chunk_id", "left")
    nested = with_vectors.groupBy("doc_id").agg(F.sort_array(F.collect_list(
        F.struct("chunk_index", "chunk_id", "content", "vector"))).alias("chunks"))
    names = document_tags.join(tags, "tag_id").groupBy("doc_id").agg(
        F.sort_array(F.collect_set("tag")).alias("tags"))
    joined = documents.join(nested, "doc_id", "left").join(names, "doc_id", "left")
    no_chunks = F.array().cast(nested.schema["chunks"].dataType)
    return joined.withColumn("chunks", F.coalesce("chunks", no_chunks)).withColumn(
        "tags", F.coalesce("tags", F.array().cast("array<string>")))


def part(turns: int | None) -> Column:
    """Number of the part a turn is in; without a size of parts a session is one part."""
    return (F.floor(F.col("turn") / turns).cast("int") if turns else F.lit(0)).alias("part")


def nest_conversations(conversations: DataFrame, users: DataFrame, messages: DataFrame, models: DataFrame,
                       part_turns: int | None = None) -> DataFrame:
    """Conversations with their user and ordered messages, each with its model when it has one."""
    detailed = messages.join(models, "model_id", "left")
    nested = detailed.groupBy("session_id", part(part_turns)).agg(F.sort_array(F.collect_list(
        F.struct("turn", "role", "content", "model_name"))).alias("messages"))
    return conversations.join(users, "user_id", "left").join(nested, "session_id", "left")


def upsert_tags(uploads: DataFrame, tags: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All tags after the uploads, and the (document, tag) rows. A tag's id is a hash of its name."""
    named = uploads.select("doc_id", F.explode("tag_names").alias("tag")).distinct()
    fresh = named.select("tag").distinct().join(tags, "tag", "left_anti").select(
        F.left(F.sha2("tag", 256), F.lit(16)).alias("tag_id"), "tag")
    merged = tags.select("tag_id", "tag").unionByName(fresh)
    return merged, named.join(merged, "tag").select("doc_id", "tag_id")


def feedback_join(feedback: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Feedback with its query, and feedback that names an unknown query."""
    return feedback.join(queries, "query_id"), feedback.join(queries, "query_id", "left_anti")


def render_chat(messages: DataFrame, template: str = "<|{role}|>{content}<|end|>",
                part_turns: int | None = None) -> DataFrame:
    """Turns of a conversation in order as one string. ``template`` holds {role} and {content}."""
    head, rest = template.split("{role}")
    middle, tail = rest.split("{content}")
    turn = F.struct("turn", "role", "content")
    ordered = F.sort_array(F.collect_list(turn))
    text = F.transform(ordered, lambda m: F.concat(
        F.lit(head), m["role"], F.lit(middle), m["content"], F.lit(tail)))
    return messages.groupBy("session_id", part(part_turns)).agg(F.array_join(text, "\n").alias("text"))


def session_summary(messages: DataFrame, width: int = 120) -> DataFrame:
    """First user message and last assistant message of every session, both cut."""
    def said(role: str, pick) -> Column:
        return F.coalesce(F.left(pick(
            F.when(F.col("role") == role, F.col("content")),
            F.when(F.col("role") == role, F.col("turn"))), F.lit(width)), F.lit(""))

    return messages.groupBy("session_id").agg(F.concat(
        F.lit("User said: "), said("user", F.min_by),
        F.lit("; assistant replied: "), said("assistant", F.max_by)).alias("summary"))


def session_documents(messages: DataFrame, part_turns: int | None = None) -> DataFrame:
    """One JSON document per session, or per part of ``part_turns`` turns where the caller asks for parts."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "content")))
    return messages.groupBy("session_id", part(part_turns)).agg(turns.alias("messages")).select(
        "session_id", "part", F.to_json(F.struct("session_id", "part", "messages")).alias("document"))


def training_pairs(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(query, text, label) rows with a float label."""
    return documents.join(labels, "doc_id").select(
        "doc_id", F.col("lang").alias("query"), "text", F.col("quality").cast("float").alias("label"))


def clone_pairs(pairs: DataFrame, query: str, new_query: str) -> DataFrame:
    """Pairs with the rows of one query repeated under a new one."""
    return pairs.unionByName(pairs.where(F.col("query") == query).withColumn("query", F.lit(new_query)))


def build_prompts(hits: DataFrame) -> DataFrame:
    """One prompt per query: header, then name, text and address of every hit in rank order."""
    passage = F.concat(
        F.lit("Document Name: "), "name", F.lit("\nText: "), "text", F.lit("\nURL: "), "url",
        F.lit("\n" + "-" * 50 + "\n"))
    ordered = F.sort_array(F.collect_list(F.struct(F.col("rank"), passage.alias("passage"))))
    return hits.groupBy("query_id", "query").agg(
        F.array_join(F.transform(ordered, lambda h: h["passage"]), "").alias("_body")
    ).select("query_id", F.concat(
        F.lit("User Query: "), "query", F.lit("\n\nRetrieved Text Passages:\n\n"), "_body").alias("prompt"))


def build_source_context(hits: DataFrame) -> DataFrame:
    """Variant with a source line over every text, joined by blank lines."""
    passage = F.concat(F.lit("[Source: "), "source_id", F.lit("]\n"), "text")
    ordered = F.sort_array(F.collect_list(F.struct(F.col("rank"), passage.alias("passage"))))
    return hits.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda h: h["passage"]), "\n\n").alias("context"))


def tag_body(text: Column, tag: str) -> Column:
    """Trimmed body of the first ``<tag>…</tag>``, else empty."""
    return F.trim(F.regexp_extract(text, f"(?s)<{tag}>(.*?)</{tag}>", 1))
