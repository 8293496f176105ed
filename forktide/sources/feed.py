"""Event feeds: block batches with nested logs, and JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forktide.functions import text, u256

LOG = (
    "struct<address:string,topics:array<string>,data:string,transactionHash:string,logIndex:bigint>"
)
BLOCK_SCHEMA = f"height bigint, hash string, ts timestamp, logs array<{LOG}>"

# Fixed value: event signature of Transfer(address,address,uint256).
TRANSFER_TOPIC = "0xddf252ad1be2c89b69c2b068fc378daa952ba7f163c4a11628f55a4df523b3ef"


def read_feed(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Archive phase: all files present."""
    return spark.read.schema(schema).parquet(path)


def stream_feed(
    spark: SparkSession, path: str, schema: str | T.StructType, files_per_batch: int = 16
) -> DataFrame:
    """Live phase: the same rows as a stream of bounded batches, oldest file first."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One JSON object per line, with a declared schema; a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSS").json(path)


def decode_transfers(blocks: DataFrame) -> DataFrame:
    """Transfer logs of block rows as transfer rows (P5).

    The signature is tested on the nested array, so other logs are dropped before they are exploded.
    """
    is_transfer = lambda log: F.get(log["topics"], 0) == TRANSFER_TOPIC
    log = F.col("log")
    rows = blocks.select(
        "height", "hash", "ts", F.explode(F.filter("logs", is_transfer)).alias("log")
    )
    return u256.with_u256(rows, "value", log["data"]).select(
        text.address(log["address"]).alias("token"),
        text.topic_address(F.get(log["topics"], 1)).alias("from"),
        text.topic_address(F.get(log["topics"], 2)).alias("to"),
        "value",
        "height",
        "hash",
        F.col("ts").alias("block_timestamp"),
        log["transactionHash"].alias("tx_hash"),
        log["logIndex"].alias("log_index"),
    )
