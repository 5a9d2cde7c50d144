"""Session settings and the shared scratch area."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Settings:
    """Engine settings; what is left as None stays as the cluster configured it."""

    app_name: str = "silverlode"
    master: str | None = None
    shuffle_partitions: int | None = None
    driver_memory: str | None = None
    time_zone: str = "UTC"


def build_session(settings: Settings = Settings()) -> SparkSession:
    builder = (
        SparkSession.builder.appName(settings.app_name)
        .config("spark.sql.session.timeZone", settings.time_zone)
        .config("spark.ui.enabled", "false")
    )
    if settings.master:
        builder = builder.master(settings.master)
    if settings.shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(settings.shuffle_partitions))
    if settings.driver_memory:
        builder = builder.config("spark.driver.memory", settings.driver_memory)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary folder only in local mode without one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        root = tempfile.mkdtemp(prefix="silverlode-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _local_roots[app] = root
    return _local_roots[app]


def file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def hide(spark: SparkSession, secret: str | None) -> Callable[[], None]:
    """Have plans and event logs show a placeholder for the secret, until the returned function is called."""
    name = "spark.sql.redaction.string.regex"
    told = spark.conf.get(name, None)
    if not secret:
        return lambda: None
    spark.conf.set(name, f"{told}|{re.escape(secret)}" if told else re.escape(secret))
    return lambda: spark.conf.set(name, told) if told else spark.conf.unset(name)


def let_shuffles_go(spark: SparkSession) -> Callable[[], None]:
    """Have the files of a shuffle go with the execution that wrote them, until the returned function is called.

    Otherwise they stay until the driver's garbage collection finds them. Not for frames that are executed
    several times: what they have shuffled would be made anew each time.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    told = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    return lambda: spark.conf.set(name, told) if told else spark.conf.unset(name)


_owned: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the scratch area; no two calls return the same one.

    All paths of an application lie in one folder, which goes when the application ends.
    """
    folder = f"{scratch_root(spark)}/silverlode-{spark.sparkContext.applicationId}"
    if folder not in _owned:
        fs, target = file_system(spark, folder)
        fs.mkdirs(target)
        fs.deleteOnExit(target)
        _owned.add(folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a folder this engine wrote, on whichever file system holds it."""
    fs, target = file_system(spark, path)
    return fs.delete(target, True)
