"""Folder operations through the Hadoop file system of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm.org.apache.hadoop.fs.Path


def exists(spark: SparkSession, path: str) -> bool:
    fs, Path = _fs(spark, path)
    return fs.exists(Path(path))


def has_parquet(spark: SparkSession, path: str) -> bool:
    """True when a dataset has been committed under the path."""
    fs, Path = _fs(spark, path)
    if not fs.exists(Path(path)):
        return False
    files = fs.listFiles(Path(path), True)
    while files.hasNext():
        if files.next().getPath().getName().endswith(".parquet"):
            return True
    return False


def delete(spark: SparkSession, path: str) -> None:
    fs, Path = _fs(spark, path)
    fs.delete(Path(path), True)


def move(spark: SparkSession, src: str, dst: str) -> None:
    fs, Path = _fs(spark, src)
    fs.mkdirs(Path(dst).getParent())
    if not fs.rename(Path(src), Path(dst)):
        raise OSError(f"could not move {src} to {dst}")


def staging_for(path: str) -> str:
    """A sibling folder on the same file system."""
    return f"{path.rstrip('/')}__staging_{uuid.uuid4().hex}"


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Put a fully written folder in place of another; the old one goes last."""
    old = staging_for(target)
    had = exists(spark, target)
    if had:
        move(spark, target, old)
    try:
        move(spark, staged, target)
    except Exception:
        if had:
            move(spark, old, target)
        raise
    if had:
        delete(spark, old)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the ``field=value`` folders directly below a path."""
    fs, Path = _fs(spark, path)
    if not fs.exists(Path(path)):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(Path(path)) if s.isDirectory() and "=" in s.getPath().getName())


def empty_files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files of no bytes below a folder, hidden ones aside; one recursive listing."""
    fs, Path = _fs(spark, path)
    out, files = [], fs.listFiles(Path(path), True)
    while files.hasNext():
        status = files.next()
        if status.getLen() == 0 and not status.getPath().getName().startswith(("_", ".")):
            out.append(status.getPath().toString())
    return out


def files_in(spark: SparkSession, path: str, suffix: str) -> list[str]:
    """Paths of the files directly in a folder whose names end so."""
    fs, Path = _fs(spark, path)
    if not fs.exists(Path(path)):
        return []
    return sorted(s.getPath().toString() for s in fs.listStatus(Path(path)) if s.isFile() and s.getPath().getName().endswith(suffix))


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file whole: it appears under its name when complete, in place of an earlier one."""
    fs, Path = _fs(spark, path)
    part = f"{path}.{uuid.uuid4().hex}.part"
    out = fs.create(Path(part), True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsparkSession.sessionState().newHadoopConf())
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context.rename(Path(part), Path(path), options)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode())


def read_text(spark: SparkSession, path: str) -> str:
    fs, Path = _fs(spark, path)
    stream = fs.open(Path(path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
