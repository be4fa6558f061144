"""Stored metrics: one directory per metric, in it one per micro-batch and attempt at it.

A batch writes all its tables and then publishes one marker, `_committed/<batch>.<attempt>`. Readers take
the batches that have a marker, so a batch that is being written, or whose writer failed between two tables,
is not there yet. A batch that is run again writes a new attempt and moves the marker.

Old batches of appended metrics are compacted from time to time, so that what a reader lists stays short.
Each compaction takes the batches since the last one; when COMPACTED_TOGETHER folders of one level stand side by
side they become one of the next level, so a row is written again only as often as there are levels. Rows
carry their batch's id, so compacted metrics give the same totals and can be read as of an older batch.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyhouse.schema import BATCH_COLUMN

FORMAT = "parquet"
COMPACTED_TOGETHER = 8
_COMMITTED, _COMPACTED, _BATCH = "_committed", "_compacted", "batch="


def metric_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def attempt_path(root: str, name: str, batch_id: int, attempt: int) -> str:
    return f"{metric_path(root, name)}/{_BATCH}{batch_id}/attempt={attempt}"


def _compacted_path(root: str, name: str, part: tuple[int, int, int]) -> str:
    return f"{metric_path(root, name)}/compacted={'.'.join(map(str, part))}"


def _directory(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def _names(spark: SparkSession, path: str) -> list[str]:
    files, where = _directory(spark, path)
    if not files.exists(where):
        return []
    return [status.getPath().getName() for status in files.listStatus(where)]


def _touch(spark: SparkSession, path: str) -> None:
    files, where = _directory(spark, path)
    files.create(where, True).close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one go."""
    files, where = _directory(spark, path)
    out = files.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _delete(spark: SparkSession, path: str) -> None:
    files, where = _directory(spark, path)
    files.delete(where, True)


def path_holds_files(spark: SparkSession, path: str) -> bool:
    return bool(_names(spark, path))


def committed(spark: SparkSession, root: str) -> dict[int, int]:
    """The attempt that counts of every batch whose tables are all written."""
    found: dict[int, int] = {}
    for name in _names(spark, f"{root.rstrip('/')}/{_COMMITTED}"):
        batch_id, attempt = map(int, name.split("."))
        found[batch_id] = max(attempt, found.get(batch_id, attempt))
    return found


def next_attempt(spark: SparkSession, root: str, batch_id: int) -> int:
    return committed(spark, root).get(batch_id, -1) + 1


def publish(spark: SparkSession, root: str, batch_id: int, attempt: int) -> None:
    """Let readers see the batch; earlier attempts at it no longer count."""
    markers = f"{root.rstrip('/')}/{_COMMITTED}"
    _touch(spark, f"{markers}/{batch_id}.{attempt}")
    for earlier in range(attempt):
        _delete(spark, f"{markers}/{batch_id}.{earlier}")


def _all_compactions(spark: SparkSession, root: str, name: str) -> list[tuple[int, int, int]]:
    """(level, first batch, last batch) of every finished compaction, also of those that went into a later one."""
    names = _names(spark, f"{metric_path(root, name)}/{_COMPACTED}")
    return [tuple(map(int, n.split("."))) for n in names]


def _compactions(spark: SparkSession, root: str, name: str) -> list[tuple[int, int, int]]:
    """Those that count, oldest batches first: the highest level of every batch."""
    found: list[tuple[int, int, int]] = []
    for level, first, last in sorted(_all_compactions(spark, root, name), reverse=True):
        if not any(f <= first and last <= l for _, f, l in found):
            found.append((level, first, last))
    return sorted(found, key=lambda part: part[1])


def _written(spark: SparkSession, root: str, name: str) -> set[int]:
    names = _names(spark, metric_path(root, name))
    return {int(n[len(_BATCH) :]) for n in names if n.startswith(_BATCH)}


def stored_batches(spark: SparkSession, root: str, name: str) -> list[int]:
    """Ids of the committed batches of a metric that are not compacted, oldest first."""
    upto = max((last for _, _, last in _compactions(spark, root, name)), default=-1)
    found = committed(spark, root).keys() & _written(spark, root, name)
    return sorted(batch_id for batch_id in found if batch_id > upto)


def newest_batch(spark: SparkSession, root: str) -> int | None:
    """The newest committed batch. A report reads all its tables as of one batch."""
    return max(committed(spark, root), default=None)


def read_metric(
    spark: SparkSession,
    root: str,
    name: str,
    latest: bool = False,
    empty_schema: T.StructType | None = None,
    fmt: str = FORMAT,
    upto: int | None = None,
) -> DataFrame:
    """All stored rows of a metric, or those of its newest batch; with ``upto``, as of that batch.

    Only the directories of the wanted batches are given to Spark, so no other is listed or read. A metric that
    has no batch yet reads as an empty frame with ``empty_schema`` and is an error without it; what an unfinished
    batch has written is never read.
    """
    attempts = committed(spark, root)
    batches = [b for b in stored_batches(spark, root, name) if upto is None or b <= upto]
    paths = [attempt_path(root, name, b, attempts[b]) for b in batches]
    older = [p for p in _compactions(spark, root, name) if upto is None or p[1] <= upto]
    if latest and paths:
        paths = paths[-1:]
    else:
        paths = [_compacted_path(root, name, part) for part in older] + paths
    if not paths:
        if empty_schema is None:
            raise LookupError(f"no committed batch of {name} below {root}")
        return spark.createDataFrame([], empty_schema)
    rows = spark.read.format(fmt).load(paths)
    if upto is not None and any(last > upto for _, _, last in older):
        rows = rows.where(F.col(BATCH_COLUMN) <= upto)
    if latest and not batches:
        newest = rows.agg(F.max(BATCH_COLUMN)).scalar()
        rows = rows.where(F.col(BATCH_COLUMN) == newest)
    return rows


def newest_of(spark: SparkSession, root: str, name: str) -> tuple[int, str] | None:
    """The newest committed batch that holds a table, and the table's folder there."""
    batches = stored_batches(spark, root, name)
    if not batches:
        return None
    return batches[-1], attempt_path(root, name, batches[-1], committed(spark, root)[batches[-1]])


def expire_batches(spark: SparkSession, root: str, name: str, keep: int) -> list[int]:
    """Remove all but the newest ``keep`` batches of a metric; the ids that went."""
    if keep < 1:
        raise ValueError("at least one batch must stay")
    old = stored_batches(spark, root, name)[:-keep]
    for batch_id in old:
        _delete(spark, f"{metric_path(root, name)}/{_BATCH}{batch_id}")
    return old


def _compact(spark: SparkSession, root: str, name: str, part: tuple[int, int, int], paths: list[str], fmt: str) -> None:
    spark.read.format(fmt).load(paths).write.format(fmt).mode("overwrite").save(_compacted_path(root, name, part))
    _touch(spark, f"{metric_path(root, name)}/{_COMPACTED}/{'.'.join(map(str, part))}")


def compact_batches(
    spark: SparkSession,
    root: str,
    names: Iterable[str],
    keep: int = 2,
    fmt: str = FORMAT,
    together: int = COMPACTED_TOGETHER,
) -> None:
    """Put all but the newest ``keep`` batches of appended metrics that are not compacted yet into one folder
    each, and folders of one level that are ``together`` into one of the next.

    What an earlier compaction replaced is deleted now, so that a reader that started before this one is not
    disturbed.
    """
    upto = max(sorted(committed(spark, root))[:-keep], default=None)
    if upto is None:
        return
    attempts, before = committed(spark, root), []
    for name in names:
        counted = _compactions(spark, root, name)
        before.append(max((last for _, _, last in counted), default=-1))
        for part in set(_all_compactions(spark, root, name)) - set(counted):
            _delete(spark, f"{metric_path(root, name)}/{_COMPACTED}/{'.'.join(map(str, part))}")
            _delete(spark, _compacted_path(root, name, part))
        for batch_id in _written(spark, root, name):
            if batch_id <= before[-1]:
                _delete(spark, f"{metric_path(root, name)}/{_BATCH}{batch_id}")
        batches = [b for b in stored_batches(spark, root, name) if b <= upto]
        if batches:
            paths = [attempt_path(root, name, b, attempts[b]) for b in batches]
            _compact(spark, root, name, (0, batches[0], batches[-1]), paths, fmt)
            counted.append((0, batches[0], batches[-1]))
        level = 0
        while len(side := [part for part in counted if part[0] == level]) >= together:
            whole = (level + 1, side[0][1], side[-1][2])
            _compact(spark, root, name, whole, [_compacted_path(root, name, part) for part in side], fmt)
            counted = [part for part in counted if part[0] != level] + [whole]
            level += 1
    for batch_id, attempt in attempts.items():
        if batch_id <= min(before, default=-1):
            _delete(spark, f"{root.rstrip('/')}/{_COMMITTED}/{batch_id}.{attempt}")
