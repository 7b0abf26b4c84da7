"""One pointer per published table: which folders make it up.

A run writes its rows into a folder of its own (``_run=<id>``), where no reader looks, and then puts the table's next pointer,
a small file with the next number, in place. Readers follow the newest pointer, so they see a publish whole or not at all, and
what they have opened stays readable while the next publish or two go by. A run that breaks off leaves a folder that nothing
points to. Of two runs that start from one version only the first can put its pointer there; the other is refused
(:class:`Conflict`) and leaves nothing behind.

Renaming to a name that exists is refused by HDFS; on a local disk two runs within the same instant could both pass. On
object stores a rename is a copy and not exclusive: publish there from one run at a time.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import files

POINTERS, RUN = "_pointers", "_run"
#: Versions that stay readable: the newest and those before it.
KEPT = 3
#: The run of folders that lay in the table before it had pointers.
ADOPTED = "adopted"


class Conflict(RuntimeError):
    """Another run published a version meanwhile."""


@dataclass(frozen=True)
class Version:
    """What a pointer says. Folders are below the table; notes are for whoever publishes next."""

    number: int
    folders: tuple[str, ...]
    notes: Mapping[str, object] = field(default_factory=dict)


def _pointer(path: str, number: int) -> str:
    return f"{path}/{POINTERS}/{number:010d}"


def _numbers(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(name) for name in files.children(spark, f"{path}/{POINTERS}") if name.isdigit())


def _version(spark: SparkSession, path: str, number: int) -> Version:
    said = json.loads(files.read_text(spark, _pointer(path, number)))
    return Version(number, tuple(said["folders"]), said["notes"])


def live(spark: SparkSession, path: str) -> Version | None:
    """The newest version; None for a table that was never published."""
    numbers = _numbers(spark, path)
    return _version(spark, path, numbers[-1]) if numbers else None


def read(
    spark: SparkSession, path: str, version: Version, fmt: str = "parquet", schema: T.StructType | str | None = None
) -> DataFrame:
    """The rows of a version. Partition columns are read from the folders, as in any table."""
    reader = spark.read.format(fmt)
    reader = reader if schema is None else reader.schema(schema)
    where = [f"{path}/{folder}" for folder in version.folders]
    if not where:
        return spark.createDataFrame([], schema)
    if "/" not in version.folders[0]:
        return reader.load(where)
    return reader.option("basePath", path).load(where).drop(RUN)


def _leaves(spark: SparkSession, path: str, folder: str, partition_by: Sequence[str]) -> list[str]:
    """The partition folders of a run, below the table."""
    found = [folder]
    for column in partition_by:
        found = [f"{f}/{name}" for f in found for name in files.children(spark, f"{path}/{f}") if name.startswith(f"{column}=")]
    return found


def _partition(folder: str) -> str:
    return folder.partition("/")[2]


def publish(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    base: Version | None = None,
    notes: Callable[[], Mapping[str, object]] = dict,
) -> Version:
    """Write ``df`` as a run and point to it. Without partition columns it is the whole table; with them its partitions
    take the place of those of the same values in ``base``, the version from which ``df`` was made, and the others stay.
    ``notes`` is asked when the rows are written."""
    spark = df.sparkSession
    if base is None and partition_by and plain_partitions(spark, path):
        raise Conflict(f"{path} has partitions without a pointer: adopt() them first")
    folder = f"{RUN}={uuid.uuid4().hex}"
    try:
        writer = df.write.option("compression", "snappy")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/{folder}")
        written = _leaves(spark, path, folder, partition_by)
        replaced = {_partition(f) for f in written}
        stay = [f for f in base.folders if _partition(f) not in replaced] if base and partition_by else []
        version = point(spark, path, base, [*stay, *written], notes())
    except BaseException:
        files.remove(spark, f"{path}/{folder}")
        raise
    clear(spark, path)
    return version


def point(
    spark: SparkSession, path: str, base: Version | None, folders: Iterable[str], notes: Mapping[str, object]
) -> Version:
    """Put the pointer that follows ``base`` in place, written whole before it gets its name."""
    version = Version(base.number + 1 if base else 1, tuple(folders), notes)
    target = _pointer(path, version.number)
    draft = f"{path}/{POINTERS}/.{uuid.uuid4().hex}"
    files.write_text(spark, draft, json.dumps({"folders": version.folders, "notes": version.notes}))
    if files.exists(spark, target) or not files.rename(spark, draft, target):
        files.remove(spark, draft)
        raise Conflict(f"{path}: another run published version {version.number} meanwhile; run the load again")
    return version


def clear(spark: SparkSession, path: str, keep: int = KEPT) -> None:
    """Remove all but the newest versions: the folders that only they have, then their pointers."""
    numbers = _numbers(spark, path)
    needed = {f for n in numbers[-keep:] for f in _version(spark, path, n).folders}
    for number in numbers[:-keep]:
        for folder in _version(spark, path, number).folders:
            if folder not in needed:
                files.remove(spark, f"{path}/{folder}")
                _remove_if_empty(spark, path, folder.partition("/")[0])
        files.remove(spark, _pointer(path, number))


def _remove_if_empty(spark: SparkSession, path: str, run: str) -> None:
    if not any("=" in name or name.endswith(".parquet") for name in _files_below(spark, f"{path}/{run}", 2)):
        files.remove(spark, f"{path}/{run}")


def _files_below(spark: SparkSession, folder: str, depth: int) -> list[str]:
    names = files.children(spark, folder)
    deeper = [n for name in names if "=" in name and depth > 1 for n in _files_below(spark, f"{folder}/{name}", depth - 1)]
    return deeper + [n for n in names if "=" not in n or depth == 1]


def sweep(spark: SparkSession, path: str, older_than_hours: float) -> list[str]:
    """Remove folders of runs that no pointer names and that are older than any run can still be at work."""
    named = {f.partition("/")[0] for n in _numbers(spark, path) for f in _version(spark, path, n).folders}
    before = (time.time() - 3600 * older_than_hours) * 1000
    gone = [
        name
        for name, changed in files.changed(spark, path).items()
        if name.startswith(f"{RUN}=") and name not in named and changed <= before
    ]
    for name in gone:
        files.remove(spark, f"{path}/{name}")
    return gone


def plain_partitions(spark: SparkSession, path: str) -> list[str]:
    """Partition folders that lie in the table itself."""
    return [n for n in files.children(spark, path) if "=" in n and not n.startswith(f"{RUN}=")]


def adopt(spark: SparkSession, path: str, partition_by: Sequence[str]) -> None:
    """Give a table that has none its first pointer: its partitions move under a run of their own. A table without
    partitions is left alone; a move that broke off is taken up again."""
    if live(spark, path) is not None:
        return
    plain = plain_partitions(spark, path)
    folder = f"{RUN}={ADOPTED}"
    if plain:
        files.make_folder(spark, f"{path}/{folder}")
        for name in plain:
            files.rename(spark, f"{path}/{name}", f"{path}/{folder}/{name}")
    if files.exists(spark, f"{path}/{folder}"):
        point(spark, path, None, _leaves(spark, path, folder, partition_by), {})
