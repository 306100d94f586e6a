"""Operators for preparing training corpora at scale.

Thirteen operators over documents, embeddings and conversations, each in its own
module, and the queries that apply them (`queries`). Nothing outside this
subpackage imports it.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Rows of whole texts in one Arrow batch: what a Python worker holds at once.
BATCH_ROWS = 1000
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Hand this package to the executors, once an application: they run its
    functions and need not have it installed. Arrow batches of this session are
    kept small, as rows hold whole texts."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(rows, min(int(spark.conf.get(rows)), BATCH_ROWS))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{root.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    context.addPyFile(path)
    _shipped.add(context.applicationId)
