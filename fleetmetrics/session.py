"""Session helpers: the scratch folder for written intermediate tables."""

import re
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the shared folder that the cluster names.

    A local session without that setting (a test) falls back to the machine's
    temporary folder; on a cluster executors would not see that folder, so
    there the setting is required.
    """
    shared = spark.conf.get(CHECKPOINT_SETTING, None)
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="fleetmetrics-")
        spark.conf.set(CHECKPOINT_SETTING, shared)
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, in a form that the optimizer can drop from a plan."""
    columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*columns).limit(0)


#: By application, the folder of the archive that its executors fetch; gone when Python ends.
_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Gives the workers this package, once for each application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    own = tempfile.TemporaryDirectory()
    package = Path(__file__).resolve().parent
    ignore = shutil.ignore_patterns("__pycache__")
    shutil.copytree(package, f"{own.name}/root/{package.name}", ignore=ignore)
    archive = shutil.make_archive(f"{own.name}/{package.name}-{context.applicationId}", "zip", f"{own.name}/root")
    context.addPyFile(archive)
    _shipped[context.applicationId] = own
