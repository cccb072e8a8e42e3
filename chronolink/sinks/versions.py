"""Tables that are replaced as a whole while others read them.

Every version lies in a folder of its own, and a numbered marker names it once it is complete. Readers follow
the highest marker, so they see one version, the old or the new one, and go on seeing it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

MARKERS = "_versions"


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path, as the cluster's own library has them."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def versions(spark: SparkSession, root: str) -> dict[int, str]:
    """Committed versions: number and folder."""
    files, where = _files(spark, f"{root}/{MARKERS}")
    if not files.exists(where):
        return {}
    names = [status.getPath().getName() for status in files.listStatus(where)]
    numbers = sorted(int(name) for name in names if name.isdigit())
    return {number: _content(spark, f"{root}/{MARKERS}/{number}") for number in numbers}


def _content(spark: SparkSession, path: str) -> str:
    files, where = _files(spark, path)
    stream = files.open(where)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def write_version(df: DataFrame, root: str, expected: int | None = None) -> int:
    """Write ``df`` as the next version and commit it; gives its number.

    The marker is written aside and renamed, so it is complete or not there; a number that is taken makes the later
    of two writers fail, and its folder is never read. ``expected`` is the version ``df`` was made from, by default the last one.
    """
    spark = df.sparkSession
    number = (max(versions(spark, root), default=0) if expected is None else expected) + 1
    folder = f"v{number}-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{folder}")
    files, draft = _files(spark, f"{root}/{MARKERS}/{folder}.draft")
    stream = files.create(draft, False)
    stream.writeUTF(folder)
    stream.close()
    marker = _files(spark, f"{root}/{MARKERS}/{number}")[1]
    if files.exists(marker) or not files.rename(draft, marker):
        files.delete(draft, False)
        raise FileExistsError(f"version {number} of {root} was committed by another writer")
    return number


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The last committed version, or an earlier one by its number."""
    known = versions(spark, root)
    if not known:
        raise FileNotFoundError(f"no committed version in {root}")
    return spark.read.parquet(f"{root}/{known[max(known) if number is None else number]}")


def drop_versions(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Remove all but the last ``keep`` versions: first the marker, then the files. Nobody should read those any more."""
    known = versions(spark, root)
    old = sorted(known)[: -keep] if keep else sorted(known)
    for number in old:
        for path in (f"{root}/{MARKERS}/{number}", f"{root}/{known[number]}"):
            files, where = _files(spark, path)
            files.delete(where, True)
    return old
