"""Messages counted for ever; words counted in windows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from windrow import constants as c
from windrow.operators.counts import running_count, tumbling_count
from windrow.operators.tokens import line_words, whitespace_words
from windrow.sinks.totals import start_totals
from windrow.streaming.queries import start_running_totals


def message_counts(raw: DataFrame, *, pattern: str = c.LINE_SEPARATOR) -> DataFrame:
    """`word, cnt` over all messages seen; see `line_words` for what a word is."""
    return running_count(line_words(raw.select("value"), pattern=pattern), "word")


def start_message_counts(
    raw: DataFrame,
    path: str,
    *,
    checkpoint: str,
    pattern: str = c.LINE_SEPARATOR,
    every: str | None = c.MESSAGE_CHECKPOINT_INTERVAL,
) -> StreamingQuery:
    """Log every new total below `path` (read it with `latest_totals`)."""
    return start_running_totals(message_counts(raw, pattern=pattern), path, checkpoint=checkpoint, every=every)


def start_message_totals(
    raw: DataFrame,
    path: str,
    *,
    checkpoint: str,
    pattern: str = c.LINE_SEPARATOR,
    every: str | None = c.MESSAGE_CHECKPOINT_INTERVAL,
) -> StreamingQuery:
    """Keep the totals below `path` as a snapshot and changes; see `windrow.sinks.totals`."""
    return start_totals(message_counts(raw, pattern=pattern), path, checkpoint=checkpoint, every=every)


def windowed_word_counts(lines: DataFrame, *, time: str = "timestamp", size: str = c.WORD_COUNT_WINDOW) -> DataFrame:
    """`word, window_start, window_end, cnt`: words per window of arrival time.

    Arrival time is an explicit column (the topic's or socket's `timestamp`), so a replay gives
    the same windows. A stream needs a watermark on it.
    """
    words = whitespace_words(lines.select("value", time))
    return tumbling_count(words, "word", size, time=time)
