"""Files and folders of whatever store a path names, through Spark's own file systems."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def java_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    return java_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(java_path(spark, path))


def delete_directory(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).delete(java_path(spark, path), True)


def make_directory(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).mkdirs(java_path(spark, path))


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote ``path`` came to its end."""
    return exists(spark, f"{path}/_SUCCESS")


def ages(spark: SparkSession, path: str) -> dict[str, float]:
    """What lies directly in a folder, with the time it was last changed, in seconds."""
    root, fs = java_path(spark, path), file_system(spark, path)
    if not fs.exists(root):
        return {}
    return {s.getPath().getName(): s.getModificationTime() / 1000 for s in fs.listStatus(root)}


def names(spark: SparkSession, path: str) -> list[str]:
    return sorted(ages(spark, path))


def data_files(spark: SparkSession, path: str) -> list[str]:
    """All files below a folder but markers and hidden ones, by one listing; relative names."""
    root, fs = java_path(spark, path), file_system(spark, path)
    if not fs.exists(root):
        return []
    above = fs.makeQualified(root).toUri().getPath().rstrip("/") + "/"
    listing, found = fs.listFiles(root, True), []
    while listing.hasNext():
        found.append(listing.next().getPath().toUri().getPath().removeprefix(above))
    return sorted(
        name for name in found if not any(step.startswith(("_", ".")) for step in name.split("/"))
    )


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text; ``FileNotFoundError`` when there is none."""
    try:
        stream = file_system(spark, path).open(java_path(spark, path))
    except Py4JJavaError as error:
        if error.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            raise FileNotFoundError(path) from error
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_new(spark: SparkSession, path: str, text: str) -> None:
    """Create a file that must not exist, at once with its whole text.

    ``FileExistsError`` if there is one. The text goes to a file of another name first, which
    then takes the name without replacing anything, so nobody sees a part of it and of two
    writers one fails. A call whose outcome the store did not report is judged by the file:
    ``text`` should be one that no other writer has.
    """
    folder, name = path.rstrip("/").rsplit("/", 1)
    make_directory(spark, folder)
    hidden = f"{folder}/.{name}-{uuid.uuid4().hex}"
    try:
        _write(spark, hidden, text)
        _publish(spark, hidden, path, text)
    except Exception as error:
        try:
            found = read_text(spark, path)
        except FileNotFoundError:
            raise error from None
        if found != text:
            raise FileExistsError(f"another writer has created {path}") from error
    finally:
        delete_directory(spark, hidden)


def _write(spark: SparkSession, path: str, text: str) -> None:
    stream = file_system(spark, path).create(java_path(spark, path), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def _publish(spark: SparkSession, hidden: str, path: str, text: str) -> None:
    """Give a file its name, an error if something has it."""
    jvm = spark._jvm
    fs = file_system(spark, path)
    if fs.getScheme() == "file":
        # A local rename would replace the file; a link does not.
        link, to = (
            jvm.java.nio.file.Paths.get(fs.makeQualified(java_path(spark, p)).toUri())
            for p in (path, hidden)
        )
        jvm.java.nio.file.Files.createLink(link, to)
        return
    options = jvm.org.apache.hadoop.fs.Options.Rename
    none = spark.sparkContext._gateway.new_array(options, 0)
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), spark._jsc.hadoopConfiguration()
        )
    except Py4JJavaError:
        # A store that only the older interface reaches shows a file when it is closed.
        _write(spark, path, text)
        return
    context.rename(java_path(spark, hidden), java_path(spark, path), none)
