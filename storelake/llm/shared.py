"""What the operators of this package have in common: reading tables, shared scratch tables, small text rules.

Intermediate tables go to the folder that ``spark.checkpoint.dir`` names, so that every executor and a
restarted task see them. Only a local session without that setting gets a folder of its own.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BLANK = re.compile(rb"[\x20\x09-\x0d]")
_local: dict[str, str] = {}
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python workers can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="storelake-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = f"{folder}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(archive)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the cluster; a local session without one gets a temporary folder."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if context.applicationId not in _local:
        folder = _local[context.applicationId] = tempfile.mkdtemp(prefix="storelake-llm-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return "file://" + _local[context.applicationId]


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/storelake-llm/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a written table: lineage ends here, and a lost executor costs no more than a reread."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, whatever the locale; other letters stay."""
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, even where the body uses it in lambdas for each element."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def spans_text(spans: Column) -> Column:
    """An array of (start, rank, kind, end) as ``kind:start:end`` by start, then rank, joined by commas."""
    parts = F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"]))
    return F.array_join(parts, ",")


def count_kinds(spans: str, kinds: tuple[str, ...]) -> list[Column]:
    """Columns n_<kind>: how many spans of an array column are of each kind."""
    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == F.lit(kind))).cast("long").alias(f"n_{kind}")
    return [count(kind) for kind in kinds]


def slices(lengths: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring items whose lengths add up to at most ``limit``; a longer item is a run of its own."""
    first, total = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(lengths):
        yield first, len(lengths)


def word_pieces(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words between ASCII blanks of a text, in lists of about ``size`` bytes, so that few are held at once."""
    at = 0
    while len(text) - at > size:
        blank = _BLANK.search(text, at + size)
        if not blank:
            break
        yield text[at:blank.start()].split()
        at = blank.end()
    yield text[at:].split() if at else text.split()
