"""Members of tar files as a data source of its own: spark.read.format("tar_members").load(folder)."""

from __future__ import annotations

import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

SCHEMA = "path string, member string, offset long, size long"
#: Rows of a batch that a task hands over.
ROWS = 10_000


class TarFile(InputPartition):
    """One tar file: its headers are read by one task."""

    def __init__(self, path: str) -> None:
        super().__init__(path)
        self.path = path


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


class TarMembersReader(DataSourceReader):
    """Lists files on the driver, by name only; headers are read in tasks, seeking from one to the next.

    Conditions on a member's end or start, and on paths, are applied here: files of other paths are not opened, other members not handed over.
    """

    def __init__(self, options: dict) -> None:
        self.root = options["path"]
        self.ends = [s.strip().lower() for s in options.get("suffixes", "").split(",") if s.strip()]
        self.paths: set[str] | None = None
        self.tests: list[tuple[str, str]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", None)
            if column == ("path",) and isinstance(f, (EqualTo, In)):
                own = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.paths = own if self.paths is None else self.paths & own
            elif column == ("member",) and isinstance(f, (StringEndsWith, StringStartsWith)):
                self.tests.append(("endswith" if isinstance(f, StringEndsWith) else "startswith", f.value))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        store, top = _opened(self.root)
        found = store.get_file_info(fs.FileSelector(top, recursive=True)) if store.get_file_info(top).type == fs.FileType.Directory else [store.get_file_info(top)]
        scheme = self.root.split("://")[0] + "://" if "://" in self.root else ""
        names = sorted(f"{scheme}{i.path}" for i in found if i.is_file and i.path.lower().endswith(".tar"))
        return [TarFile(n) for n in names if self.paths is None or n in self.paths]

    def read(self, partition: TarFile) -> Iterator[pa.RecordBatch]:
        store, name = _opened(partition.path)
        rows: list[tuple] = []

        def batch() -> pa.RecordBatch:
            member, offset, size = zip(*rows)
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            columns = [pa.array(c, t) for c, t in zip(([partition.path] * len(rows), member, offset, size), kinds)]
            return pa.RecordBatch.from_arrays(columns, names=["path", "member", "offset", "size"])

        with store.open_input_file(name) as f, tarfile.open(fileobj=f, mode="r:") as t:
            for m in t:
                t.members = []  # headers passed are not kept
                if not m.isfile() or m.name.startswith("/") or ".." in m.name.split("/"):
                    continue
                if (self.ends and not m.name.lower().endswith(tuple(self.ends))) or not all(getattr(m.name, test)(value) for test, value in self.tests):
                    continue
                rows.append((m.name, m.offset_data, m.size))
                if len(rows) >= ROWS:
                    yield batch()
                    rows.clear()
        if rows:
            yield batch()


class TarMembers(DataSource):
    """(path, member, offset, size) of the safe plain files in the .tar files below a folder; option `suffixes`: ends of members, in any case."""

    @classmethod
    def name(cls) -> str:
        return "tar_members"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return TarMembersReader(self.options)


def register(spark: SparkSession) -> None:
    """Makes the source known to a session, and lets Spark hand conditions to sources written in Python."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TarMembers)
