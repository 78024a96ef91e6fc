"""Optional, beyond batch: arrivals as a stream, merged batch by batch into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from basalt.operators.merge import merge_records


def merge_stream(stream: DataFrame, path: str, checkpoint: str, keys: list[str]) -> DataStreamWriter:
    """Append every batch of arrivals to ``path``; ``merged`` reads the state. Replayed batches overwrite their own folder."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")

    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)


def merged(arrivals: DataFrame, keys: list[str]) -> DataFrame:
    return merge_records(arrivals.drop("epoch"), keys)
