"""Streaming versions of cleaning, parsing, history and de-duplication."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.functions import templates as tp
from textloom.functions.text import clean_review, lower_collapsed, word_count
from textloom.plans import sqltext as q
from textloom.plans.registry import query
from textloom.plans.texts import _CLEAN_SQL
from textloom.sources.readers import parse_json_lines
from textloom.sources.scratch import new_path
from textloom.sources.writers import write_json_lines
from textloom.streaming import streams


@query(
    "r1_clean_stream",
    f"SELECT doc_id, lower(array_to_string({q.words(_CLEAN_SQL)}, ' ')) AS cleaned FROM documents",
)
def clean_stream(t):
    def clean(df):
        return df.select("doc_id", lower_collapsed(clean_review(F.col("text"))).alias("cleaned"))

    return streams.map_stream(streams.table_stream(t.spark, t.folder, "documents"), clean, "clean")


@query(
    "r1_json_prompt_stream",
    "SELECT doc_id, 'Prompt: ' || lang || ' Completion: ' || text AS prompt FROM documents WHERE lang <> 'es'",
)
def json_prompt_stream(t):
    """Lines are parsed, broken ones dropped, and the rest put into a template, as they arrive."""
    full = F.to_json(F.struct("doc_id", "lang", "text"))
    broken = F.substring(full, F.lit(1), F.length(full) - 5)
    lines = t.documents.select(F.when(F.col("lang") == "es", broken).otherwise(full).alias("value"))
    path = write_json_lines(lines, new_path(t.spark, "drops"))
    schema = T.StructType.fromDDL("doc_id bigint, lang string, text string")

    def parse(df):
        rows = parse_json_lines(df, schema, required=["text"])
        return rows.select("doc_id", tp.fill("Prompt: {} Completion: {}", F.col("lang"), F.col("text")).alias("prompt"))

    return streams.map_stream(t.spark.readStream.text(path), parse, "prompts")


@query(
    "r2_history_stream",
    f"""WITH {q.PAIRS}, x AS (SELECT conv_id, pair_turn, {q.word_count('question')} + {q.word_count('answer')} AS tokens FROM pairs),
    s AS (SELECT a.conv_id, a.pair_turn, b.pair_turn AS back, sum(b.tokens) OVER (PARTITION BY a.conv_id, a.pair_turn ORDER BY b.pair_turn DESC) AS used
          FROM x a JOIN x b ON a.conv_id = b.conv_id AND b.pair_turn <= a.pair_turn)
    SELECT conv_id, pair_turn, count(*) FILTER (used <= 200)::INTEGER AS kept_pairs, coalesce(max(used) FILTER (used <= 200), 0)::BIGINT AS used_tokens
    FROM s GROUP BY conv_id, pair_turn""",
)
def history_stream(t):
    turns = streams.table_stream(t.spark, t.folder, "conversations")
    counted = turns.select("conv_id", "turn", "role", word_count(F.col("text")).alias("tokens"))
    return streams.history_stream(counted, 200, "history")


@query("r3_distinct_stream", "SELECT DISTINCT text, md5(text) AS h FROM documents")
def distinct_stream(t):
    texts = streams.table_stream(t.spark, t.folder, "documents").select("text")
    return streams.distinct_stream(texts, "text", "distinct")


@query(
    "r4_label_counts",
    """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS window_start, event_type, count(*) AS n
    FROM events, (SELECT max(ts) - INTERVAL 10 MINUTE AS mark FROM events)
    GROUP BY ALL HAVING date_trunc('hour', any_value(ts)) + INTERVAL 1 HOUR <= any_value(mark)""",
)
def label_counts(t):
    """Events by type in hours of their own time; an hour counts once the watermark has passed it."""
    events = streams.table_stream(t.spark, t.folder, "events")
    timed = events.select(F.col("ts").cast("timestamp").alias("ts"), "event_type")
    counts = streams.run_available(streams.window_counts(timed, "ts", "event_type"), "windows")
    return counts.select(F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"), "event_type", "n")
