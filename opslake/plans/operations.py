"""Queries over sessions, requests, feedback and releases."""

from __future__ import annotations

from pyspark.sql import functions as F

from opslake import inputs as src
from opslake.functions import vector as vec
from opslake.inputs import AS_OF
from opslake.operators import chunking, releases, sessions
from opslake.plans.catalog import AS_OF as NOW
from opslake.plans.catalog import VIEWS, WORDS, oracle, query


def docs(spark, sf):
    return src.table(spark, sf, "documents")


# Conversations

@query("last_n_messages", oracle("session_id turn role content", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS rn FROM messages)
    WHERE rn <= 3""", "messages"))
def _(spark, sf):
    return sessions.last_messages(src.messages(spark, sf), 3).select("session_id", "turn", "role", "content")


@query("session_ttl", oracle("session_id turn", """
    SELECT session_id, turn FROM messages WHERE session_id IN (SELECT session_id FROM messages GROUP BY 1
        HAVING max(created_at) >= TIMESTAMP '2024-01-02 12:00:00' - INTERVAL 1 HOUR)""", "messages"))
def _(spark, sf):
    return sessions.live_sessions(src.messages(spark, sf), "2024-01-02 12:00:00").select("session_id", "turn")


@query("messages_after", oracle("session_id turn role", """
    SELECT session_id, turn, role FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn) AS rn
        FROM messages WHERE conv_id % 2 = 1 OR turn > 1) WHERE rn <= 4""", "messages"))
def _(spark, sf):
    rows = src.messages(spark, sf)
    after = rows.where("conv_id % 2 = 0 AND turn = 1").select("session_id", F.col("turn").alias("after_turn"))
    return sessions.messages_after(rows, after, 4).select("session_id", "turn", "role")


@query("render_chat", oracle("session_id part:i text", """
    SELECT session_id, 0 AS part, string_agg('<|' || role || '|>' || content || '<|end|>', chr(10) ORDER BY turn) AS text
    FROM messages GROUP BY 1""", "messages"))
def _(spark, sf):
    return sessions.render_chat(src.messages(spark, sf))


@query("session_summary", oracle("session_id summary", """
    SELECT session_id, 'User said: ' || coalesce(left(arg_min(content, turn) FILTER (WHERE role = 'user'), 120), '')
        || '; assistant replied: '
        || coalesce(left(arg_max(content, turn) FILTER (WHERE role = 'assistant'), 120), '') AS summary
    FROM messages GROUP BY 1""", "messages"))
def _(spark, sf):
    return sessions.session_summary(src.messages(spark, sf))


@query("extract_tags", oracle("session_id turn thinking answer", """
    SELECT session_id, turn, 'turn ' || CAST(turn AS VARCHAR) AS thinking,
           CASE WHEN turn % 2 = 0 THEN trim(content) ELSE '' END AS answer FROM messages""", "messages"))
def _(spark, sf):
    said = F.concat(
        F.lit("<think> turn "), F.col("turn").cast("string"), F.lit(" </think>\n"),
        F.when(F.col("turn") % 2 == 0, F.concat(F.lit("<answer>"), "content", F.lit("</answer>"))).otherwise("none"))
    return src.messages(spark, sf).select(
        "session_id", "turn", sessions.tag_body(said, "think").alias("thinking"),
        sessions.tag_body(said, "answer").alias("answer"))


@query("event_sequence", oracle("event_id user_id sequence_id:i", """
    SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS sequence_id FROM events"""))
def _(spark, sf):
    rows = src.table(spark, sf, "events").select("event_id", "user_id", "ts")
    return sessions.event_sequence(rows, "user_id", "ts", "event_id").drop("ts")


@query("session_filter", oracle("event_id ts:t", "SELECT event_id, ts FROM events WHERE user_id = 42"))
def _(spark, sf):
    return sessions.session_events(src.table(spark, sf, "events"), "user_id", 42).select("event_id", "ts")


def timing_events(spark, sf):
    ms = F.col("value") * 10
    payload = F.to_json(F.struct(
        F.col("event_type").alias("stage"), F.lit(0.0).alias("started_at_ms"), ms.alias("completed_at_ms"),
        ms.alias("duration_ms")))
    return src.table(spark, sf, "events").select(F.lit("timing").alias("event_type"), payload.alias("payload"))


@query("stage_latency", oracle("stage turns:i avg_ms:r max_ms:r p50_ms:r p99_ms:r", """
    SELECT event_type AS stage, count(*) AS turns, avg(value * 10) AS avg_ms, max(value * 10) AS max_ms,
           quantile_cont(value * 10, 0.5) AS p50_ms, quantile_cont(value * 10, 0.99) AS p99_ms
    FROM events GROUP BY 1"""))
def _(spark, sf):
    return sessions.stage_latency(timing_events(spark, sf))


# Requests, caches, feedback

@query("daily_quota", oracle('request_id "user" local_day:d admitted:b remaining:i reset_day:d', """
    SELECT request_id, "user", local_day, rn <= 2 AS admitted, greatest(2 - rn, 0) AS remaining,
           local_day + 1 AS reset_day
    FROM (SELECT *, row_number() OVER (PARTITION BY "user", local_day ORDER BY ts, request_id) AS rn
          FROM (SELECT *, CAST(ts + INTERVAL 4 HOUR AS DATE) AS local_day FROM requests))""", "requests"))
def _(spark, sf):
    return sessions.daily_quota(src.requests(spark, sf), 2).drop("ts")


VIEWS["pairs"] = (["requests"], """
    SELECT prompt_id, a AS latency_a_ms, b AS latency_b_ms, fa AS failed_a, fb AS failed_b FROM (
        SELECT prompt_id, max(latency_ms) FILTER (WHERE backend = 'a') AS a,
               max(latency_ms) FILTER (WHERE backend = 'b') AS b, bool_or(failed) FILTER (WHERE backend = 'a') AS fa,
               bool_or(failed) FILTER (WHERE backend = 'b') AS fb FROM requests GROUP BY 1)
    WHERE a IS NOT NULL AND b IS NOT NULL""")


@query("ab_latency", oracle("prompt_id latency_a_ms:r latency_b_ms:r latency_diff_ms:r faster both_succeeded:b", """
    SELECT *, round(abs(latency_a_ms - latency_b_ms), 2) AS latency_diff_ms,
           CASE WHEN latency_a_ms < latency_b_ms THEN 'a' ELSE 'b' END AS faster, NOT failed_a AND NOT failed_b
           AS both_succeeded FROM pairs""", "pairs"))
def _(spark, sf):
    return sessions.compare_backends(src.requests(spark, sf)).drop("failed_a", "failed_b")


@query("ab_latency_summary", oracle(
    "total_requests:i both_succeeded:i avg_latency_a_ms:r avg_latency_b_ms:r faster_a:i", """
    SELECT count(*) AS total_requests, count(*) FILTER (WHERE NOT failed_a AND NOT failed_b) AS both_succeeded,
           round(CAST(avg(latency_a_ms) FILTER (WHERE NOT failed_a) AS DECIMAL(30, 9)), 2) AS avg_latency_a_ms,
           round(CAST(avg(latency_b_ms) FILTER (WHERE NOT failed_b) AS DECIMAL(30, 9)), 2) AS avg_latency_b_ms,
           count(*) FILTER (WHERE latency_a_ms < latency_b_ms) AS faster_a FROM pairs""", "pairs"))
def _(spark, sf):
    return sessions.comparison_summary(sessions.compare_backends(src.requests(spark, sf)))


@query("append_new_only", oracle("query_hash response", """
    SELECT DISTINCT md5(text) AS query_hash, lang AS response FROM documents WHERE NOT EXISTS (
        SELECT 1 FROM documents d WHERE d.doc_id % 3 = 0 AND d.text = documents.text AND d.lang = documents.lang)
    UNION ALL SELECT md5('new ' || text), lang FROM documents WHERE doc_id % 7 = 0"""))
def _(spark, sf):
    pairs = docs(spark, sf).select("doc_id", F.col("text").alias("query_text"), F.col("lang").alias("response"))
    fresh = pairs.select("query_text", "response").distinct().unionByName(pairs.where("doc_id % 7 = 0").select(
        F.concat(F.lit("new "), "query_text").alias("query_text"), "response"))
    added = sessions.append_new_only(fresh, pairs.where("doc_id % 3 = 0"), ["query_text", "response"])
    return added.select(F.md5("query_text").alias("query_hash"), "response")


@query("cache_lookup", oracle("request_id response:i hit:b", """
    SELECT d.doc_id AS request_id, c.response, c.response IS NOT NULL AS hit FROM documents d LEFT JOIN (
        SELECT text, min(doc_id) AS response FROM documents WHERE doc_id % 4 = 0 GROUP BY ALL) c ON c.text = d.text"""))
def _(spark, sf):
    asked = docs(spark, sf).select(F.col("doc_id").alias("request_id"), F.col("text").alias("prompt"))
    cache = asked.where("request_id % 4 = 0").withColumnRenamed("request_id", "response")
    return sessions.cache_lookup(asked, cache).select("request_id", "response", "hit")


@query("feedback_join", oracle("query_id quality:i known:b", """
    SELECT l.doc_id AS query_id, quality, d.doc_id IS NOT NULL AS known
    FROM labels l LEFT JOIN (SELECT doc_id FROM documents WHERE doc_id % 3 <> 0) d ON d.doc_id = l.doc_id"""))
def _(spark, sf):
    feedback = src.table(spark, sf, "labels").select(F.col("doc_id").alias("query_id"), "quality")
    asked = docs(spark, sf).where("doc_id % 3 <> 0").select(F.col("doc_id").alias("query_id"))
    known, unknown = sessions.feedback_join(feedback, asked)
    return known.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False)))


@query("training_pairs", oracle("doc_id query text_hash label:r", """
    WITH pairs AS (SELECT l.doc_id, d.lang AS query, md5(d.text) AS text_hash, l.quality AS label
                   FROM labels l JOIN documents d ON d.doc_id = l.doc_id)
    SELECT * FROM pairs UNION ALL SELECT doc_id, 'deutsch', text_hash, label FROM pairs WHERE query = 'de'"""))
def _(spark, sf):
    pairs = sessions.training_pairs(docs(spark, sf), src.table(spark, sf, "labels"))
    return sessions.clone_pairs(pairs, "de", "deutsch").select("doc_id", "query", F.md5("text").alias("text_hash"), "label")


@query("upsert_tags", oracle("doc_id tag_id tag", """
    SELECT DISTINCT doc_id, CASE tag WHEN 'en' THEN '1' WHEN 'fr' THEN '2' ELSE left(sha256(tag), 16) END AS tag_id, tag
    FROM (SELECT doc_id, lang AS tag FROM documents UNION ALL SELECT doc_id, source FROM documents)"""))
def _(spark, sf):
    uploads = docs(spark, sf).select("doc_id", F.array("lang", "source").alias("tag_names"))
    held = docs(spark, sf).select(F.col("lang").alias("tag")).distinct().where("tag IN ('en', 'fr')").withColumn(
        "tag_id", F.when(F.col("tag") == "en", "1").otherwise("2"))
    tags, doc_tags = sessions.upsert_tags(uploads, held)
    return doc_tags.join(tags, "tag_id").select("doc_id", "tag_id", "tag")


@query("nested_documents", oracle("doc_id n_chunks:i n_vectors:i tags:a last_chunk", f"""
    SELECT d.doc_id, coalesce(c.n, 0) AS n_chunks, coalesce(c.v, 0) AS n_vectors, [d.lang, d.source] AS tags, c.last_chunk
    FROM documents d LEFT JOIN (
        SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE i % 2 = 0) AS v, arg_max(chunk, i) AS last_chunk FROM (
            SELECT doc_id, i, array_to_string(list_slice(words, i * 100 + 1, i * 100 + 100), ' ') AS chunk FROM (
                SELECT doc_id, words, unnest(range(0, CAST(ceil(len(words) / 100.0) AS BIGINT))) AS i
                FROM (SELECT doc_id, {WORDS} AS words FROM documents) WHERE len(words) >= 400)) GROUP BY doc_id) c
    ON c.doc_id = d.doc_id"""))
def _(spark, sf):
    rows = docs(spark, sf)
    chunks = chunking.chunk_fixed(rows, 100, 400).select(
        "doc_id", "chunk_index", F.concat_ws(":", "doc_id", "chunk_index").alias("chunk_id"), F.col("text").alias("content"))
    embedded = chunks.where("chunk_index % 2 = 0").select("chunk_id", vec.hash_embed(F.col("content")).alias("vector"))
    uploads = rows.select("doc_id", F.array("lang", "source").alias("tag_names"))
    none = rows.select(F.col("lang").alias("tag_id"), F.col("lang").alias("tag")).limit(0)
    tags, doc_tags = sessions.upsert_tags(uploads, none)
    nested = sessions.nest_documents(rows.select("doc_id"), chunks, embedded, doc_tags, tags)
    return nested.select(
        "doc_id", F.size("chunks").alias("n_chunks"),
        F.size(F.filter("chunks", lambda c: c["vector"].isNotNull())).alias("n_vectors"), "tags",
        F.get("chunks", F.size("chunks") - 1)["content"].alias("last_chunk"))


@query("nested_conversations", oracle("session_id user_name n_messages:i last_content last_model", """
    SELECT session_id, 'User ' || CAST(any_value(conv_id) % 10 AS VARCHAR) AS user_name, count(*) AS n_messages,
           arg_max(content, turn) AS last_content,
           arg_max(CASE WHEN role = 'assistant' THEN 'Model one' ELSE '-' END, turn) AS last_model
    FROM messages GROUP BY session_id""", "messages"))
def _(spark, sf):
    rows = src.messages(spark, sf).withColumn("model_id", F.when(F.col("role") == "assistant", "m1"))
    conversations = rows.select("session_id", (F.col("conv_id") % 10).alias("user_id")).distinct()
    users = conversations.select("user_id").distinct().withColumn(
        "user_name", F.concat(F.lit("User "), F.col("user_id").cast("string")))
    models = rows.select("model_id").distinct().where("model_id IS NOT NULL").withColumn("model_name", F.lit("Model one"))
    nested = sessions.nest_conversations(conversations, users, rows, models)
    last = F.get("messages", F.size("messages") - 1)
    return nested.select("session_id", "user_name", F.size("messages").alias("n_messages"),
                         last["content"].alias("last_content"), F.coalesce(last["model_name"], F.lit("-")).alias("last_model"))


# Releases

METRICS = "runs:i quality_score:r consistency_score:r error_rate:r latency_p50_ms:r latency_p99_ms:r"


def metrics(spark, sf):
    return releases.release_metrics(src.runs(spark, sf), ["model", "slot"])


def side_by_side(spark, sf):
    """One row per model with the metrics of both releases."""
    rows = metrics(spark, sf)
    names = ["error_rate", "quality_score", "latency_p99_ms"]

    def of(slot: str, name: str):
        return F.max(F.when(F.col("slot") == slot, F.col(name))).alias(f"{slot}_{name}")

    return rows.groupBy("model").agg(*[of(s, n) for s in ("blue", "green") for n in names])


def pairs_sql(drift: str) -> str:
    """Decision of every model: the gates in order."""
    return f"""
    SELECT *, CASE WHEN ge > 0.05 OR gq < 0.70 THEN 'rollback_to_blue'
        WHEN gl > 1000 OR drift > 0.25 THEN 'hold_for_review' WHEN gq - bq < 0.02 THEN 'stay_on_blue'
        WHEN ge > be * 1.5 OR gl > bl * 1.3 THEN 'hold_for_review' ELSE 'switch_to_green' END AS decision
    FROM (SELECT model, {drift} AS drift,
             max(error_rate) FILTER (WHERE slot = 'blue') AS be, max(error_rate) FILTER (WHERE slot = 'green') AS ge,
             max(quality_score) FILTER (WHERE slot = 'blue') AS bq, max(quality_score) FILTER (WHERE slot = 'green') AS gq,
             max(latency_p99_ms) FILTER (WHERE slot = 'blue') AS bl, max(latency_p99_ms) FILTER (WHERE slot = 'green') AS gl
          FROM metrics GROUP BY model)"""


VIEWS["release_table"] = (["runs"], """
    SELECT model || '/' || slot AS release_id, model, slot, 'candidate' AS status, min(ts) AS created_at
    FROM runs GROUP BY ALL""")


def release_table(spark, sf):
    return src.runs(spark, sf).groupBy("model", "slot").agg(F.min("ts").alias("created_at")).select(
        F.concat_ws("/", "model", "slot").alias("release_id"), "model", "slot", F.lit("candidate").alias("status"),
        "created_at")


@query("releases_latest", oracle("release_id model slot status created_at:t", "SELECT * FROM release_table",
                                 "release_table"))
def _(spark, sf):
    return releases.latest_releases(release_table(spark, sf))


@query("release_metrics", oracle(f"model slot {METRICS}", "SELECT * FROM metrics", "metrics"))
def _(spark, sf):
    return metrics(spark, sf)


# Drift of a model in steps of a tenth, so that every gate closes for some.
STEPPED_DRIFT = "CAST(substr(model, 7) AS INTEGER) % 5 * 0.1e0"
#: The sentence of the first gate that closes, with its figures struck out.
RATIONALE = f"""
    SELECT model, decision, CASE WHEN ge > 0.05 THEN 'Green error rate # exceeds max #' WHEN gq < 0.70 THEN 'Green quality # below min #'
        WHEN gl > 1000 THEN 'Green p# latency #ms exceeds max #ms' WHEN drift > 0.25 THEN 'Drift score # exceeds threshold #'
        WHEN gq - bq < 0.02 THEN 'Green quality improvement # below min # (blue=#, green=#)' || CASE WHEN ge <= be AND gl <= bl
            THEN '; Green is not worse on error/latency, but quality gain is marginal' ELSE '' END
        WHEN ge > be * 1.5 THEN 'Green error rate # is >#x blue (#)' WHEN gl > bl * 1.3 THEN 'Green latency #ms is >#x blue (#ms)'
        ELSE 'Green passes all gates: quality=# (+#), error_rate=#, p#=#ms, drift=#' END AS rationale
    FROM ({pairs_sql(STEPPED_DRIFT)})"""


@query("release_gates", oracle("model decision rationale", RATIONALE, "metrics"))
def _(spark, sf):
    decided = releases.decide(side_by_side(spark, sf).withColumn("drift_score", F.expr("CAST(substr(model, 7) AS INT) % 5 * 0.1D")))
    return decided.select("model", "decision", F.regexp_replace("rationale", r"-?\d[\d.]*", "#").alias("rationale"))


@query("release_transition", oracle("release_id status decision", f"""
    SELECT release_id, decision, CASE WHEN decision = 'switch_to_green' AND slot = 'blue' THEN 'archived'
        WHEN decision = 'switch_to_green' THEN 'active_green'
        WHEN decision = 'rollback_to_blue' AND slot = 'green' THEN 'rolled_back'
        WHEN decision = 'rollback_to_blue' THEN 'active_blue' ELSE status END AS status
    FROM release_table JOIN ({pairs_sql('0.0e0')}) USING (model)""", "release_table", "metrics"))
def _(spark, sf):
    decided = releases.decide(side_by_side(spark, sf).withColumn("drift_score", F.lit(0.0)))
    return releases.apply_decisions(release_table(spark, sf), decided).select("release_id", "status", "decision")


@query("replay_compare", oracle(
    "inputs:i blue_quality:r green_quality:r blue_error:r green_error:r recommendation", """
    SELECT *, CASE WHEN green_quality > blue_quality AND green_error <= blue_error THEN 'switch_to_green'
                   ELSE 'stay_on_blue' END AS recommendation
    FROM (SELECT count(*) AS inputs, avg(b.quality) AS blue_quality, avg(g.quality) AS green_quality,
                 avg(CASE WHEN b.failed THEN 1e0 ELSE 0e0 END) AS blue_error,
                 avg(CASE WHEN g.failed THEN 1e0 ELSE 0e0 END) AS green_error
          FROM runs b JOIN runs g ON b.input_id = g.input_id AND b.slot = 'blue' AND g.slot = 'green')""", "runs"))
def _(spark, sf):
    return releases.replay_compare(src.runs(spark, sf))


def psi(column: str) -> str:
    bins = " + ".join(f"CASE WHEN x > e[{i}] THEN 1 ELSE 0 END" for i in range(1, 10))
    return f"""
    SELECT '{column}' AS "column", sum((q - p) * ln(q / p)) AS psi FROM (
        SELECT greatest(count(*) FILTER (WHERE ref) / CAST(any_value(rt) AS DOUBLE), 1e-6) AS p,
               greatest(count(*) FILTER (WHERE NOT ref) / CAST(any_value(ct) AS DOUBLE), 1e-6) AS q
        FROM (SELECT {column} AS x, event_time < {NOW} - INTERVAL 24 HOUR AS ref,
                     count(*) FILTER (WHERE event_time < {NOW} - INTERVAL 24 HOUR) OVER () AS rt,
                     count(*) FILTER (WHERE event_time >= {NOW} - INTERVAL 24 HOUR) OVER () AS ct FROM telemetry),
             (SELECT quantile_cont({column}, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM telemetry
              WHERE event_time < {NOW} - INTERVAL 24 HOUR)
        GROUP BY {bins})"""


VIEWS["psi"] = (["telemetry"], " UNION ALL ".join(psi(c) for c in ("temperature", "vibration", "pressure")))
DRIFT = """SELECT *, drift_score > 0.2 AS drift_detected, drift_score > 0.25 AS drift_alert FROM (
    SELECT *, greatest(input_shift, output_shift, feature_drift_pct) AS drift_score FROM (
        SELECT max(psi) FILTER (WHERE "column" <> 'pressure') AS input_shift,
               max(psi) FILTER (WHERE "column" = 'pressure') AS output_shift,
               avg(CASE WHEN psi > 0.2 THEN 1e0 ELSE 0e0 END) AS feature_drift_pct FROM psi))"""


def drift(spark, sf):
    rows = src.telemetry(spark, sf)
    cut = F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 24 HOURS")
    per_column = releases.drift(rows.where(F.col("event_time") < cut), rows.where(F.col("event_time") >= cut),
                                ["temperature", "vibration", "pressure"])
    return releases.drift_score(per_column, ["temperature", "vibration"], ["pressure"])


@query("drift", oracle("input_shift:r output_shift:r feature_drift_pct:r drift_score:r drift_detected:b drift_alert:b",
                       DRIFT, "psi"))
def _(spark, sf):
    return drift(spark, sf)


@query("evaluate_then_decide", oracle("model decision recommendation drift_score:r", f"""
    SELECT model, decision, (SELECT CASE WHEN avg(g.quality) > avg(b.quality)
               AND avg(CASE WHEN g.failed THEN 1e0 ELSE 0e0 END) <= avg(CASE WHEN b.failed THEN 1e0 ELSE 0e0 END)
               THEN 'switch_to_green' ELSE 'stay_on_blue' END
           FROM runs b JOIN runs g ON b.input_id = g.input_id AND b.slot = 'blue' AND g.slot = 'green') AS recommendation,
           (SELECT drift_score FROM ({DRIFT})) AS drift_score
    FROM ({pairs_sql(f"(SELECT drift_score FROM ({DRIFT}))")})""", "metrics", "psi"))
def _(spark, sf):
    moved = drift(spark, sf).select("drift_score").scalar()
    advice = releases.replay_compare(src.runs(spark, sf)).select("recommendation").scalar()
    decided = releases.decide(side_by_side(spark, sf).withColumn("drift_score", moved))
    return decided.select("model", "decision", advice.alias("recommendation"), "drift_score")
