"""The package on the executors: Python workers import it to run the functions of the operators.

Arrow batches are bound by bytes too, so that the memory of a task does not depend on how long texts are: ten thousand rows, Spark's default
bound, may be gigabytes. One row may still be longer than the bound.
"""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path
from weakref import WeakSet

from pyspark import SparkContext
from pyspark.sql import SparkSession

BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_done: WeakSet[SparkContext] = WeakSet()


def ship(spark: SparkSession) -> None:
    """Sends the package's sources to all executors through Spark, once a session, and bounds the session's Arrow batches.

    The zip is made on the driver only. A bound set for the whole application stays.
    """
    context = spark.sparkContext
    if not context.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    if context in _done:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _done.add(context)
