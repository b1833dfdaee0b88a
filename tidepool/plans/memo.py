"""Derived folders that several catalogue queries read (the drained pipeline, the version chain).

They are built once per application and state of the input: the key holds the number, bytes and
newest modification time of the input's files, so a changed input is built anew."""

from __future__ import annotations

import threading
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidepool.operators.layout import list_files
from tidepool.session import table_path

Built = TypeVar("Built")
_lock = threading.RLock()  # one build at a time, even with concurrent callers
_built: dict[tuple, object] = {}


def fingerprint(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> tuple:
    out = []
    for t in tables:
        files = list_files(spark, table_path(sf_dir, t))
        out.append(tuple(files.agg(F.count("*"), F.sum("file_bytes"), F.max("mtime").cast("string")).first()))
    return tuple(out)


def built_once(spark: SparkSession, sf_dir: str, name: str, tables: tuple[str, ...], build: Callable[[], Built]) -> Built:
    with _lock:
        key = (spark.sparkContext.applicationId, sf_dir, name, fingerprint(spark, sf_dir, tables))
        if key not in _built:
            _built[key] = build()
        return _built[key]


def all_built(name: str) -> list:
    with _lock:
        return [v for k, v in _built.items() if k[2] == name]
