"""Message sources and the external buffer table."""

from pyspark.sql import DataFrame, SparkSession

BUFFER_COLUMNS = "nId, strMachineName, fA, fV, nTemperature, dtInsert"


def landing_stream(
    spark: SparkSession, folder: str, files_per_batch: int | None = None
) -> DataFrame:
    """Text files with one message per line, as they land in a folder."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def kafka_stream(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """One message per record; needs the Kafka connector on the class path."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return reader.option("subscribe", topic).load().select("value")


def landing_files(spark: SparkSession, folder: str) -> DataFrame:
    """The same files, read once as a batch."""
    return spark.read.text(folder)


def buffer_options(
    url: str, table: str, cursor: int, last_id: int, partitions: int, fetch_size: int = 10_000
) -> dict[str, str]:
    """JDBC options for the rows after the cursor, split by id range."""
    return {
        "url": url,
        "dbtable": f"(SELECT {BUFFER_COLUMNS} FROM {table} WHERE nId > {int(cursor)}) AS fresh",
        "partitionColumn": "nId",
        "lowerBound": str(int(cursor) + 1),
        "upperBound": str(int(last_id)),
        "numPartitions": str(int(partitions)),
        "fetchsize": str(int(fetch_size)),
    }


def jdbc_buffer(
    spark: SparkSession, url: str, table: str, cursor: int, last_id: int, partitions: int = 8
) -> DataFrame:
    """An external buffer table; needs its JDBC driver on the class path."""
    options = buffer_options(url, table, cursor, last_id, partitions)
    return spark.read.format("jdbc").options(**options).load()
