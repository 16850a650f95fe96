"""Where written tables, stream folders and saved models of one run live.

The folder must be visible to the driver and to every executor. It is the one that the
session names in ``spark.checkpoint.dir``, or else a folder below the warehouse, which
every session has and which a cluster shares.
"""

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    folder = (spark.conf.get("spark.checkpoint.dir", None)
              or spark.sparkContext.getCheckpointDir()
              or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_work")
    return folder.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path nobody has used yet, below the shared folder; nothing is created."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/rasmlens/{app}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    at, files = _on_filesystem(spark, path)
    return files.exists(at)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that match a pattern with wildcards."""
    at, files = _on_filesystem(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(at) or ()]


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, size and time of change of a file, or of all files below a folder."""
    at, files = _on_filesystem(spark, path)
    found, each = [], files.listFiles(at, True)
    while each.hasNext():
        status = each.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a text file in UTF-8, which may be compressed."""
    at, files = _on_filesystem(spark, path)
    jvm, stream = spark._jvm, files.open(at)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(at)
        plain = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    at, files = _on_filesystem(spark, path)
    files.delete(at, True)


def clear(spark: SparkSession) -> None:
    """Delete everything that this application has stored below the shared folder. Results
    that still read from there must have been written elsewhere before."""
    delete(spark, f"{shared_dir(spark)}/rasmlens/{spark.sparkContext.applicationId}")


def _on_filesystem(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())
