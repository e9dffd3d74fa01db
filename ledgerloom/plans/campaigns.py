"""Campaign files into one text table per channel."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from ..sources.csv_folder import campaign_frames
from ..sources.tables import append_text


def campaign_ingest(spark: SparkSession, folder: str, target: str, as_of: datetime) -> dict[str, bool]:
    """Append every channel's rows to ``target/<channel>``; tells which had any."""
    frames = campaign_frames(spark, folder, as_of)
    return {channel: append_text(df, f"{target}/{channel}") for channel, df in frames.items()}
