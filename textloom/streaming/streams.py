"""File-source streams that give the same rows as their batch counterparts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from textloom.sources.scratch import new_path


def table_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 100) -> DataFrame:
    """A stream of the table `name` of a folder, be it one parquet file or a folder of part files."""
    path = f"{folder}/{name}.parquet"
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", files_per_batch)
    if store.getFileStatus(jvm_path).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def start_available(stream: DataFrame, name: str, mode: str = "append") -> tuple[StreamingQuery, str]:
    """Start to process everything that has arrived; the running query and the table it writes.

    Output and stream checkpoint live in the shared folder, so a restarted
    query goes on where it stopped.
    """
    root = new_path(stream.sparkSession, name)
    query = (
        stream.writeStream.outputMode(mode)
        .format("parquet")
        .option("path", f"{root}/table")
        .option("checkpointLocation", f"{root}/state")
        .trigger(availableNow=True)
        .start()
    )
    return query, f"{root}/table"


def run_available(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process everything that has arrived, then read the written table back."""
    query, path = start_available(stream, name, mode)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def map_stream(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], name: str) -> DataFrame:
    """A row-local step as a stream."""
    return run_available(transform(stream), name)


HORIZON_MS = 7 * 24 * 3600 * 1000
HISTORY_SCHEMA = "conv_id bigint, pair_turn bigint, kept_pairs int, used_tokens bigint"
_STATE_SCHEMA = "question_turn bigint, question_tokens bigint, turns array<bigint>, tokens array<bigint>"


def history_stream(turns: DataFrame, budget: int, name: str, horizon_ms: int = HORIZON_MS) -> DataFrame:
    """Budgeted history after every completed user/assistant pair, stored and read back."""
    return run_available(histories(turns, budget, horizon_ms), name)


def histories(turns: DataFrame, budget: int, horizon_ms: int = HORIZON_MS, delay: str = "1 minute") -> DataFrame:
    """Budgeted history after every completed user/assistant pair, as a stream.

    State per conversation: an unanswered question and the pairs that still
    fit the budget, so it never outgrows the budget. A conversation without a
    turn for `horizon_ms` is forgotten, so the state holds the conversations of
    one horizon and not of all time; its next turn starts a new history. Time is
    that of arrival, and `delay` is how far the clocks of two batches may step
    back.  Input: `(conv_id, turn,
    role, tokens)`; the turns of one conversation inside one micro-batch are
    put in order before use, so size micro-batches with `maxFilesPerTrigger`.
    """

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        asked, asked_tokens, kept_turns, kept = state.get if state.exists else (None, 0, [], [])
        kept_turns, kept, out = list(kept_turns), list(kept), []
        rows = pd.concat(list(frames)).sort_values("turn")
        for row in rows.itertuples(index=False):
            if row.role == "user":
                asked, asked_tokens = int(row.turn), int(row.tokens)
            elif row.role == "assistant" and asked == row.turn - 1:
                kept_turns.append(asked)
                kept.append(asked_tokens + int(row.tokens))
                while kept and sum(kept) > budget:
                    kept.pop(0), kept_turns.pop(0)
                out.append((key[0], asked, len(kept), sum(kept)))
                asked = None
        state.update((asked, asked_tokens, kept_turns, kept))
        state.setTimeoutTimestamp(max(int(rows["arrived_ms"].max()), state.getCurrentWatermarkMs()) + horizon_ms)
        yield pd.DataFrame(out, columns=["conv_id", "pair_turn", "kept_pairs", "used_tokens"])

    arrived = turns.select("conv_id", "turn", "role", "tokens", F.current_timestamp().alias("arrived"))
    timed = arrived.withColumn("arrived_ms", F.unix_millis("arrived")).withWatermark("arrived", delay)
    return timed.groupBy("conv_id").applyInPandasWithState(
        step, HISTORY_SCHEMA, _STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout
    )


def distinct_stream(stream: DataFrame, text: str, name: str, time: str | None = None, delay: str = "7 days") -> DataFrame:
    """First arrival of each text, by its hash, stored and read back."""
    return run_available(distinct_rows(stream, text, time, delay), name)


def distinct_rows(stream: DataFrame, text: str, time: str | None = None, delay: str = "7 days") -> DataFrame:
    """First arrival of each text, by its hash, as a stream.

    Hashes older than the watermark are forgotten: `delay` behind the time
    column, or behind the arrival of the newest batch if there is none. A copy
    that comes later than that is a first arrival again.
    """
    hashed = stream.withColumn("h", F.md5(F.col(text).cast("binary")))
    if time is not None:
        return hashed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["h"])
    arrived = hashed.withColumn("__arrived", F.current_timestamp()).withWatermark("__arrived", delay)
    return arrived.dropDuplicatesWithinWatermark(["h"]).drop("__arrived")


def window_counts(stream: DataFrame, time: str, label: str, length: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """`(window_start, label, n)` of closed tumbling windows, as a stream.

    A window closes when the watermark, `delay` behind the newest time seen,
    reaches its end; it is then written once and its state dropped. Rows that
    come for a closed window are late and not counted. Rows without a time are
    in no window; a null label is a label of its own.
    """
    kept = stream.filter(F.col(time).isNotNull()).withWatermark(time, delay)
    counted = kept.groupBy(F.window(time, length), label).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), label, "n")
