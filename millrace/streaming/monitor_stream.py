"""Structured Streaming forms of the log operators."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.session import exists


def log_stream(spark: SparkSession, folder: str, schema, form: str = "parquet") -> DataFrame:
    """Files appended to a folder, as a stream; a single file is a stream of one."""
    reader = spark.readStream.schema(schema).format(form)
    if exists(spark, folder, as_file=True):
        parent, _, name = folder.rstrip("/").rpartition("/")
        return reader.option("pathGlobFilter", name).load(parent or "/")
    return reader.load(folder)


def latest_per_key(stream: DataFrame, keys: list[str], order: list[str], carry: list[str]) -> DataFrame:
    """The newest row of each key so far (complete or update mode)."""
    return stream.groupBy(*keys).agg(F.max(F.struct(*order, *carry)).alias("_last")).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in dict.fromkeys([*order, *carry])])


def level_counts(stream: DataFrame, time: str, level, window: str = "5 minutes", late: str = "15 minutes") -> DataFrame:
    """Samples by time window and level; rows later than ``late`` are left out."""
    return stream.withColumn("level", level).withWatermark(time, late).groupBy(F.window(time, window), "level").agg(F.count(F.lit(1)).alias("n"))


def suppressed(stream: DataFrame, key: str, seconds: str, least: float = 1800.0) -> DataFrame:
    """Alerts that are written, a message again only if more than ``least`` seconds passed since.

    State is one number a message. Rows of a micro-batch are taken in order
    of time; a row older than the last written alert is not written.
    """

    def walk(own: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        times = sorted(t for b in batches for t in b[seconds].dropna())
        out = []
        for t in times:
            if last is None or t - last > least:
                out.append(t)
                last = t
        if last is not None:
            state.update((float(last),))
        yield pd.DataFrame({key: [own[0]] * len(out), seconds: out})

    kind = stream.schema[key].dataType.simpleString()
    return stream.where(F.col(key).isNotNull()).select(key, seconds).groupBy(key).applyInPandasWithState(walk, f"{key} {kind}, {seconds} double", "last double", "append", GroupStateTimeout.NoTimeout)


def moving_average(stream: DataFrame, key: str, order: list[str], value: str, width: int = 10) -> DataFrame:
    """``key, order..., average`` over each row and the ``width`` before it of its key, once there are so many.

    A window by count has no time bound, so the state of a key is its last
    ``width`` values. Rows of a micro-batch are taken in ``order``; rows
    without key are left out.
    """
    columns = [key, *order]
    ddl = ", ".join(f"{c} {stream.schema[c].dataType.simpleString()}" for c in columns)

    def walk(own: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(batches)).sort_values(order, kind="stable").reset_index(drop=True)
        before = list(state.get[0]) if state.exists else []
        values = pd.Series([*before, *rows[value].astype(float)])
        rows["average"] = values.rolling(width + 1).apply(lambda w: w.sum() / (width + 1), raw=True).to_numpy()[len(before) :]
        state.update((values.tail(width).tolist(),))
        yield rows.loc[rows["average"].notna(), [*columns, "average"]]

    return stream.where(F.col(key).isNotNull()).select(*columns, value).groupBy(key).applyInPandasWithState(walk, f"{ddl}, average double", "last array<double>", "append", GroupStateTimeout.NoTimeout)


def run_every(stream: DataFrame, sink: str, checkpoint: str, seconds: float = 60.0) -> StreamingQuery:
    """A query that takes what has come every so many seconds, 5 at least, whatever a batch takes."""
    every = f"{max(seconds, 5.0):g} seconds"
    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).trigger(processingTime=every).format("parquet").option("path", sink).start()


def run_once(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Processes what is there and ends: files for append mode, overwriting batches otherwise."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if mode == "append":
        query = writer.format("parquet").option("path", sink).start()
    else:
        query = writer.foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(sink)).start()
    query.awaitTermination()
