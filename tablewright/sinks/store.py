"""Small file operations through Spark's Hadoop file systems, so that tables may
live in any store Spark can reach.  Metadata-sized work only: no row passes here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none when it does not exist."""
    fs = _fs(spark, path)
    if not fs.exists(_path(spark, path)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(_path(spark, path)))


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files below ``path``, relative to it, hidden ones left out."""
    fs, base = _fs(spark, path), _path(spark, path)
    if not fs.exists(base):
        return []
    root = fs.makeQualified(base).toString().rstrip("/") + "/"
    found, it = [], fs.listFiles(base, True)
    while it.hasNext():
        relative = it.next().getPath().toString()[len(root):]
        if not any(part[0] in "_." for part in relative.split("/")):
            found.append(relative)
    return sorted(found)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; None when it does not exist."""
    fs = _fs(spark, path)
    if not fs.exists(_path(spark, path)):
        return None
    stream = fs.open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all it holds; nothing happens when it is absent."""
    _fs(spark, path).delete(_path(spark, path), True)


def move_new(spark: SparkSession, source: str, target: str) -> None:
    """Move a file; a target that exists already (an earlier attempt moved it) is kept."""
    fs, to = _fs(spark, target), _path(spark, target)
    if fs.exists(to):
        fs.delete(_path(spark, source), False)
        return
    fs.mkdirs(to.getParent())
    if not fs.rename(_path(spark, source), to):
        raise OSError(f"cannot move {source} to {target}")
