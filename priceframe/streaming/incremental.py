"""Incremental enrichment with Structured Streaming.

New fact files dropped into a folder are cleaned, their missing incomes are
filled from the per-capita panel (a stream-static left join), and the rows are
appended to the year-partitioned snapshot.  The checkpoint folder (by default
``_checkpoint`` within the output folder, so that both belong together) records
which files were done: a restarted or failed run on the same output resumes
there, without lost or repeated rows.  The operators are the
batch ones; nothing here is stateful beyond the file log.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import clean, enrich


def enrich_stream(spark: SparkSession, facts_dir: str, panel: DataFrame, out_path: str,
                  schema: T.StructType, panel_keys=("iso", "year"), value: str = "per_capita",
                  checkpoint: str | None = None, fmt: str = "csv", available_now: bool = True,
                  max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; with ``available_now`` it processes what is there and stops."""
    reader = spark.readStream.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    facts = clean.clean_facts(reader.load(facts_dir))
    filled = enrich.join_fill(facts, panel, ["iso_a3", "year"], list(panel_keys), value)
    out = enrich.fill_from(filled, "GDP_dollar", value)
    ckpt = checkpoint or f"{out_path.rstrip('/')}/_checkpoint"
    w = (out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", ckpt)
         .partitionBy("year"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start(out_path)
