"""Line-oriented Kafka topics.

The decode/encode stages are plain column expressions over a ``value`` column, so
they run (and are tested) without the Kafka connector; ``read_kafka_lines`` /
``publish_lines_kafka`` only add the connector options around them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def decode_lines(df: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """CAST(value AS STRING) -> from_csv with a fixed schema -> one column per field."""
    ddl = schema.simpleString()[len("struct<"):-1].replace(":", " ")
    rec = F.from_csv(F.col(value_col).cast("string"), ddl, {"mode": "PERMISSIVE"})
    return df.select(rec.alias("r")).select("r.*")


def encode_lines(df: DataFrame, cols=None) -> DataFrame:
    """One comma-separated text line per row, in a ``value`` column (no key)."""
    cols = cols or df.columns
    return df.select(F.to_csv(F.struct(*cols)).alias("value"))


def read_kafka_lines(spark: SparkSession, servers: str, topic: str, schema: StructType,
                     group_id: str | None = None, starting: str = "latest") -> DataFrame:
    """Streaming read of a string topic from the latest offsets (needs the Kafka connector)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return decode_lines(r.load(), schema)


def publish_lines_kafka(df: DataFrame, servers: str, topic: str) -> None:
    """Batch publish of every row as one text line (needs the Kafka connector)."""
    (encode_lines(df).write.format("kafka").option("kafka.bootstrap.servers", servers)
     .option("topic", topic).save())
