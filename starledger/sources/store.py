"""Named tables: typed reads, and overwrites that readers see whole or not at all.

``format`` and ``options`` go straight to Spark's reader and writer, so any deployed
connector works. A store with a ``root`` keeps each table in a folder of its own; one
without passes the table name in the connector's option (``name_option``).

In a folder store every write is a version: a folder of its own under the table's, which nobody
reads until an empty marker file names it. Creating that file is the commit, a single step on any
file system or object store, and the marker with the greatest number is the table. Nothing
is renamed or replaced, so there is no moment without a table; readers keep the version they began
with, and of two writers at a time one is the later version, whole.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from starledger.shared import delete_folder, file_system
from starledger.sources.layout import clustered, interleaved

_MARKERS = "_versions"


@dataclass(frozen=True)
class Store:
    """``versions`` of a table are kept, so that whoever reads one may finish."""

    root: str | None = None
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    name_option: str = "collection"
    versions: int = 2

    @property
    def keeps_layout(self) -> bool:
        """Whether rows laid out by a key are found faster: in column files of a folder."""
        return self.root is not None and self.format in ("parquet", "orc")

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def folder(self, spark: SparkSession, name: str) -> str:
        """Where the table's rows are now: its last version, or what others wrote to its path."""
        target = self.path(name)
        markers = _markers(spark, target)
        return f"{target}/{_version(markers[-1])}" if markers else target

    def exists(self, spark: SparkSession, name: str) -> bool:
        """Whether a folder store has the table."""
        fs, place = file_system(spark, self.path(name))
        return bool(_markers(spark, self.path(name))) or (fs.exists(place) and not _has_versions(fs, place))

    def load(self, spark: SparkSession, name: str) -> DataFrame:
        reader = spark.read.format(self.format).options(**self.options)
        if self.root is None:
            return reader.option(self.name_option, name).load()
        return reader.load(self.folder(spark, name))


def read_table(
    spark: SparkSession, store: Store, name: str, schema: str | StructType
) -> DataFrame:
    """A stored table in the declared column order and types; further columns are dropped."""
    declared = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    return store.load(spark, name).select(*declared.names).to(declared)


def write_table(
    df: DataFrame,
    store: Store,
    name: str,
    *,
    cluster_by: str | Sequence[str] | None = None,
    lookup_keys: Sequence[str] = (),
    order_by: Sequence[Column | str] = (),
    files: int | None = None,
) -> None:
    """Replace a named table.

    ``cluster_by`` lays the rows out by that key, or by several so that each can be looked up;
    ``lookup_keys`` get Bloom filters, so a further key can be looked up too. Both raise for a store that ``keeps_layout`` is false
    of. ``order_by`` sorts the whole table. ``files`` asks for so many files, or partitions
    handed to a connector, at any size; they keep the order from one to the next. Fewer are
    written only if there are fewer different rows.

    In a folder store the rows are a new version of the table once they are complete: a failed
    job leaves the table as it was, and ``df`` may read the table it replaces. Versions before
    the last ``store.versions`` are deleted. A driver that is lost leaves a folder that no marker
    names, which ``delete_unfinished`` removes.
    """
    if (cluster_by or lookup_keys) and not store.keeps_layout:
        raise ValueError(f"a {store.format} store cannot lay rows out by a key")
    several = cluster_by is not None and not isinstance(cluster_by, str)
    if several and (files is not None or order_by):
        raise ValueError("several keys are laid out without a number of files or an order")
    order = list(order_by) or ([cluster_by] if cluster_by and not several else [])
    if files is not None:
        df = df.repartitionByRange(files, *order) if order and files > 1 else df.repartition(files)
        df = df.sortWithinPartitions(*order) if order else df
    elif several:
        df = interleaved(df, cluster_by)
    elif cluster_by:
        df = clustered(df, cluster_by)
    elif order:
        df = df.orderBy(*order)
    options = {**store.options, **_lookup_options(store.format, lookup_keys)}
    writer = df.write.format(store.format).options(**options).mode("overwrite")
    if store.root is None:
        writer.option(store.name_option, name).save()
        return
    spark, target = df.sparkSession, store.path(name)
    version = f"version-{uuid.uuid4().hex}"
    try:
        writer.save(f"{target}/{version}")
    except BaseException:
        delete_folder(spark, f"{target}/{version}")
        raise
    _commit(spark, target, version, store.versions)


def delete_unfinished(spark: SparkSession, store: Store, name: str, older_than_hours: float = 168) -> None:
    """Delete versions without a marker, as lost drivers leave them, that are older than given."""
    target = store.path(name)
    fs, place = file_system(spark, target)
    if not fs.exists(place):
        return
    before = time.time() * 1000 - older_than_hours * 3_600_000
    known = {_version(marker) for marker in _markers(spark, target)}
    for status in fs.listStatus(place):
        found = status.getPath().getName()
        if found.startswith("version-") and found not in known and status.getModificationTime() < before:
            fs.delete(status.getPath(), True)


def _lookup_options(fmt: str, keys: Sequence[str]) -> dict[str, str]:
    if not keys:
        return {}
    if fmt == "orc":
        return {"orc.bloom.filter.columns": ",".join(keys)}
    if fmt == "parquet":
        return {f"parquet.bloom.filter.enabled#{key}": "true" for key in keys}
    return {}


def _markers(spark: SparkSession, target: str) -> list[str]:
    """Names of the markers, the last version's at the end: a number and the version."""
    fs, folder = file_system(spark, f"{target}/{_MARKERS}")
    if not fs.exists(folder):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(folder))


def _version(marker: str) -> str:
    return marker.partition("-")[2]


def _has_versions(fs, place) -> bool:
    return any(status.getPath().getName().startswith("version-") for status in fs.listStatus(place))


def _commit(spark: SparkSession, target: str, version: str, keep: int) -> None:
    markers = _markers(spark, target)
    number = int(markers[-1].partition("-")[0]) + 1 if markers else 0
    fs, marker = file_system(spark, f"{target}/{_MARKERS}/{number:020d}-{version}")
    fs.create(marker, False).close()
    for old in _markers(spark, target)[: -max(keep, 1)]:
        fs.delete(file_system(spark, f"{target}/{_MARKERS}/{old}")[1], False)
        delete_folder(spark, f"{target}/{_version(old)}")
