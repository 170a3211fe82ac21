"""The two kinds of streaming job: normalization, and windowed ranking."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql import functions as F

from tillstream import constants as C
from tillstream.operators.aggregate import sales_by_window
from tillstream.operators.normalize import (
    filter_country, normalize_sales, quarantine, quarantine_unified, read_unified, unify_sources,
    unplaceable_times,
)
from tillstream.operators.rank import top_n_per_window
from tillstream.sinks.rankings import append_rankings, ranking_rows
from tillstream.sinks.topic import stream_topic, unified_records


def normalization_job(topics: Mapping[str, DataFrame], out: str, checkpoint: str, *,
                      fmt: str = "kafka", options: dict[str, str] | None = None,
                      now_ms: Column | None = None) -> DataStreamWriter:
    """Source topics, by source name, to the unified topic. Narrow from end to end.

    Data-quality counters and the number of malformed records are in the progress, as
    `quality_<source>` and `quality_<source>_read`. `quarantine_job` takes the malformed records
    themselves; a deployment starts both.
    """
    events = unify_sources(*[
        normalize_sales(records, source, now_ms=now_ms, quality=f"quality_{source}")
        for source, records in topics.items()])
    return stream_topic(unified_records(events), out, checkpoint, fmt=fmt, options=options)


def quarantine_job(topics: Mapping[str, DataFrame], out: str, checkpoint: str) -> DataStreamWriter:
    """The malformed records of the source topics, with their source, to a parquet folder."""
    parts = [quarantine(records).select(F.lit(source).alias("source"), "value")
             for source, records in topics.items()]
    return _aside(reduce(DataFrame.unionByName, parts), out, checkpoint)


def ranking_quarantine_job(records: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    """Records of the unified topic that the ranking jobs can't use, with the reason."""
    unread = quarantine_unified(records).select(F.lit("unreadable").alias("reason"), "value")
    timeless = unified_records(unplaceable_times(read_unified(records))).select(
        F.lit("unplaceable").alias("reason"), "value")
    return _aside(unread.unionByName(timeless), out, checkpoint)


def _aside(rows: DataFrame, out: str, checkpoint: str) -> DataStreamWriter:
    return (rows.writeStream.format("parquet").outputMode("append")
            .option("checkpointLocation", checkpoint).option("path", out))


def windowed_totals(sales: DataFrame, key: str, length: str = C.WINDOW_LENGTH,
                    out_of_order: str = C.OUT_OF_ORDERNESS,
                    country: str | None = None, one_watermark: bool = True) -> DataFrame:
    """Totals of closed windows, optionally of one country.

    One watermark over the unified input, not one per source; if not `one_watermark`, the input has its own
    (`watermarks.with_source_watermarks`). Rows of every country advance it. The observed input count is of
    use itself, and it keeps the optimizer from moving the country filter below the watermark, which would
    then see the rows of that country only.
    """
    if one_watermark:
        sales = sales.withWatermark("event_time", out_of_order)
    arrived = sales.observe("arrived", F.count(F.lit(1)).alias("rows"))
    kept = arrived if country is None else filter_country(arrived, country)
    return sales_by_window(kept, key, length)


RankingWriter = Callable[[DataFrame, str], None]


def ranking_job(sales: DataFrame, key: str, path: str, checkpoint: str, *,
                country: str | None = None, n: int = C.TOP_N, length: str = C.WINDOW_LENGTH,
                write: RankingWriter = append_rankings, one_watermark: bool = True) -> DataStreamWriter:
    """Rank each window once it closes, into the ranking table at `path`.

    `sales` streams `event_time`, `amount` and the key. All totals of a window leave the
    aggregation in one micro-batch, which ranks them and writes them in one job. Late rows
    never reach it. A micro-batch that runs twice appends a second version of its windows,
    which reads through `latest_windows` fold away; `write=replace_rankings` also puts that version
    above all that other jobs wrote.
    """
    totals = windowed_totals(sales, key, length, country=country, one_watermark=one_watermark)
    return (
        totals.writeStream.outputMode("append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(_rank_and_write(key, path, country, n, write))
    )


def _rank_and_write(key: str, path: str, country: str | None, n: int,
                    write: RankingWriter) -> Callable[[DataFrame, int], None]:
    def rank_and_write(totals: DataFrame, batch_id: int) -> None:
        ranked = top_n_per_window(totals, key, n)
        if country is not None:
            ranked = ranked.withColumn("country", F.lit(country))
        write(ranking_rows(ranked, batch_id=batch_id), path)
    return rank_and_write


def start_continuous(writer: DataStreamWriter,
                     interval: str = C.CHECKPOINT_INTERVAL) -> StreamingQuery:
    """Run until stopped, a micro-batch and a commit per interval."""
    return writer.trigger(processingTime=interval).start()


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Process what is there now, in as many micro-batches as the source makes of it."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query
