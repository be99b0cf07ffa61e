"""Path checks and moves through the Hadoop file system of the session."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs_and_path(spark: SparkSession, path: str):
    jvm = spark._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return fs.exists(p)


def is_directory(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def make_directory(spark: SparkSession, path: str) -> None:
    fs, p = _fs_and_path(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_and_path(spark, path)
    return fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename within one file system; the parent of ``target`` is created."""
    fs, src = _fs_and_path(spark, source)
    _, dst = _fs_and_path(spark, target)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, or not at all if there is one of that name; tells which.

    The text is written beside and then takes its name, which fails where the name is taken: by a
    hard link on local disks, by a rename on file systems whose renames refuse existing targets.
    """
    fs, target = _fs_and_path(spark, path)
    fs.mkdirs(target.getParent())
    beside = f"{target.getParent()}/.{target.getName()}.{uuid.uuid4().hex}"
    _, source = _fs_and_path(spark, beside)
    stream = fs.create(source, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if target.toUri().getScheme() in (None, "file"):
            place = spark._jvm.java.nio.file.Paths.get
            empty = spark.sparkContext._gateway.new_array(spark._jvm.java.lang.String, 0)
            try:
                spark._jvm.java.nio.file.Files.createLink(place(target.toUri().getPath(), empty), place(source.toUri().getPath(), empty))
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" in str(e.java_exception):
                    return False
                raise
            return True
        return not fs.exists(target) and fs.rename(source, target)
    finally:
        fs.delete(source, False)


def files(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """``(folder, name)`` of the data files anywhere below ``path``, in order; hidden ones are left out."""
    fs, p = _fs_and_path(spark, path)
    found, out = fs.listFiles(p, True), []
    while found.hasNext():
        at = found.next().getPath()
        if not at.getName().startswith(("_", ".")):
            out.append((at.getParent().toString(), at.getName()))
    return sorted(out)


def input_files(df) -> list[str]:
    """``df.inputFiles()``, handed over in one piece: one call a name takes minutes for long lists."""
    names = df._jdf.inputFiles()
    # They are URI-encoded, so none holds a line break.
    return df.sparkSession._jvm.org.apache.hadoop.util.StringUtils.join("\n", names).split("\n") if len(names) else []


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and authority."""
    fs, p = _fs_and_path(spark, path)
    return fs.makeQualified(p).toString()


def swap(spark: SparkSession, source: str, target: str) -> None:
    """Put ``source`` in the place of ``target``; the old one is deleted last, and comes back on failure."""
    if not exists(spark, target):
        move(spark, source, target)
        return
    aside = f"{target}.old-{uuid.uuid4().hex}"
    move(spark, target, aside)
    try:
        move(spark, source, target)
    except BaseException:
        move(spark, aside, target)
        raise
    delete(spark, aside)


def inside(spark: SparkSession, path: str, folder: str) -> bool:
    """Whether a path is the folder or lies below it."""
    path, folder = qualified(spark, path).rstrip("/"), qualified(spark, folder).rstrip("/")
    return path == folder or path.startswith(folder + "/")
