"""Send this library to the Python workers of a session."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

import adtally

_SENT: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Once a session; Spark's own file transfer takes the archive to every executor, later ones too."""
    context = spark.sparkContext
    if context.applicationId in _SENT:
        return
    top = os.path.dirname(os.path.abspath(adtally.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="adtally-code-"), "adtally.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(top)))
    context.addPyFile(archive)
    _SENT.add(context.applicationId)
