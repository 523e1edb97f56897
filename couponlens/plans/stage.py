"""Written intermediate tables in the session's shared folder.

A DataFrame used by several consumers that Catalyst prunes differently
(each keeps only its own columns) cannot share one exchange, so it would be
recomputed once per consumer. Writing it once cuts that, and cuts the
lineage: an executor lost later makes Spark re-read files, not redo the
aggregation. Tables are memoised per application and key; the key holds the
state of the files they come from (``source_state``), so replaced input is
never answered from an old table. Written folders go when the application
ends.
"""

from __future__ import annotations

import hashlib
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from couponlens.session import file_status, hadoop_path, shared_dir

_paths: dict[tuple, str] = {}
_frames: dict[tuple, DataFrame] = {}
_locks: dict[tuple, threading.RLock] = defaultdict(threading.RLock)
_guard = threading.Lock()


def source_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """Digest of path, length and modification time of every file under ``paths``."""
    digest = hashlib.sha256()
    for path in paths:
        for status in sorted(file_status(spark, path)):
            digest.update(repr(status).encode())
    return digest.hexdigest()


def lock_of(key: tuple) -> threading.RLock:
    """One lock per key: builds of different tables do not wait for each other."""
    with _guard:
        return _locks[key]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    p, fs = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return path


def staged(spark: SparkSession, key: tuple, build: Callable[[], DataFrame],
           write: Callable[[DataFrame, str], None] | None = None,
           read: Callable[[SparkSession, str], DataFrame] | None = None) -> DataFrame:
    """Write ``build()`` once per (application, key) and return it read back.

    The written path is shared by every session of the application; each
    session reads it into its own DataFrame once.
    """
    app = spark.sparkContext.applicationId
    with lock_of((app, *key)):
        df = _frames.get((app, id(spark), *key))
        if df is not None and df.sparkSession is spark:
            return df
        path = _paths.get((app, *key))
        if path is None:
            path = new_folder(spark, key[0])
            (write or _write_parquet)(build(), path)
            _paths[(app, *key)] = path
        df = (read or _read_parquet)(spark, path)
        _frames[(app, id(spark), *key)] = df
        return df


def _write_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
