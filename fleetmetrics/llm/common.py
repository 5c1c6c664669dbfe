"""What the operators share: tables, written intermediates, Arrow row mapping."""

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fleetmetrics.session import scratch_folder, ship

SLICE = 128
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared folder and read again: computed once,
    and no longer dependent on executors that may be lost."""
    spark = frame.sparkSession
    folder = scratch_folder(spark, label)
    frame.write.parquet(folder)
    forget_shuffles(spark)
    made = spark.read.schema(frame.schema).parquet(folder)
    made._stored_in = folder
    return made


def forget_shuffles(spark: SparkSession) -> None:
    """What was shuffled for ended queries is not needed again; Spark deletes it once collected."""
    # Spark's listeners hold the last query that ended, and so its shuffle files, until another one ends.
    spark.range(1).collect()
    spark._jvm.System.gc()


def release(*frames: DataFrame) -> None:
    """Deletes written intermediates that no later step reads."""
    for frame in frames:
        spark = frame.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(frame._stored_in)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(frame: DataFrame, wanted: str) -> str:
    """The name, lengthened until no column of the frame has it."""
    taken = {c.lower() for c in frame.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def blobs(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of each text; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


#: The one costly object that a worker holds: workers live longer than stages, and
#: what an earlier stage has cached must not stand beside what the next one caches.
_held: dict[tuple, object] = {}


def held(key: tuple, make: Callable[[], object]):
    """The object of this key in this worker, made on first use; others are let go."""
    if key not in _held:
        _held.clear()
        _held[key] = make()
    return _held[key]


def map_batches(frame: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """mapInArrow, with this package on the workers."""
    ship(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def map_column(
    frame: DataFrame,
    source: str,
    new: Sequence[T.StructField],
    function: Callable[[pa.Array], Iterable[tuple]],
    keep: Sequence[str],
) -> DataFrame:
    """The columns `keep` and, from `function` over the batches of `source`, new ones.

    `function` takes an Arrow column of at most SLICE texts and gives a tuple per
    row. Rows stay in their partitions; only a slice's texts and results are
    Python objects at once.
    """
    sent = frame.select(F.col(f"`{source}`").alias(free_name(frame, "__source")), *[F.col(f"`{c}`") for c in keep])
    schema = T.StructType([*sent.schema.fields[1:], *new])
    arrow = to_arrow_schema(T.StructType(list(new)))

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                columns = zip(*function(part.column(0)), strict=True)
                made = [pa.array(v, f.type) for v, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *made], names=[*part.schema.names[1:], *arrow.names])

    return map_batches(sent, mapped, schema)
