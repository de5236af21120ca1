"""Small files beside tables, on whatever file system they live."""

from __future__ import annotations

from pyspark.sql import SparkSession


def on_system(spark: SparkSession, path: str):
    """A path and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, system = on_system(spark, path)
    return system.exists(hadoop)


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, in order; nothing if it is not there."""
    hadoop, system = on_system(spark, folder)
    return sorted(s.getPath().getName() for s in system.listStatus(hadoop)) if system.exists(hadoop) else []


def folders(spark: SparkSession, pattern: str) -> dict[str, set[str]]:
    """The folders that match, each with the names of its files."""
    hadoop, system = on_system(spark, pattern)
    found = [f.getPath() for f in system.globStatus(hadoop) or []]
    return {p.toString(): {f.getPath().getName() for f in system.listStatus(p)} for p in found}


def remove(spark: SparkSession, path: str) -> None:
    hadoop, system = on_system(spark, path)
    system.delete(hadoop, True)


def read_text(spark: SparkSession, path: str) -> str:
    hadoop, system = on_system(spark, path)
    stream = system.open(hadoop)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return text


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole: it is written under another name first."""
    folder, name = path.rsplit("/", 1)
    draft, system = on_system(spark, f"{folder}/draft-{name}")
    stream = system.create(draft, True)
    stream.write(text.encode())
    stream.close()
    final, _ = on_system(spark, path)
    if system.exists(final):
        system.delete(final, False)
    system.rename(draft, final)


def modified(spark: SparkSession, path: str) -> int:
    """Milliseconds of the last change of a file, or of any file of a folder."""
    hadoop, system = on_system(spark, path)
    status = system.getFileStatus(hadoop)
    inside = system.listStatus(hadoop) if status.isDirectory() else [status]
    return max([s.getModificationTime() for s in inside], default=status.getModificationTime())
