"""Send this package to executors that do not have it installed."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_sent: set[str] = set()


#: Rows in an Arrow batch, where the session has Spark's default: long texts make large rows.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> SparkSession:
    """Add the package to the application once; the driver serves it, so no folder needs to be shared."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(batch, "10000") == "10000":
        spark.conf.set(batch, str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app not in _sent:
        root = Path(__file__).resolve().parent
        name = os.path.join(tempfile.mkdtemp(prefix="loomgraph-code-"), "loomgraph.zip")
        with zipfile.ZipFile(name, "w") as z:
            for p in sorted(root.rglob("*.py")):
                z.write(p, p.relative_to(root.parent))
        spark.sparkContext.addPyFile(name)
        _sent.add(app)
    return spark
