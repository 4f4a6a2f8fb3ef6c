"""Files with names of their own: a Spark data source that writes each row (path, content) as one file under a folder.

A task writes into a folder of its own below `_temporary`; the driver moves the files of the tasks that ended to their places
once all have, and deletes the folder. A task that fails, or whose attempt isn't the one that counts, leaves nothing. Paths
are those of pyarrow's file systems, shared by driver and executors; a file that is there already is replaced.

    spark.dataSource.register(NamedFiles)
    df.select("path", "content").write.format("named_files").mode("append").save("/shared/out")
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import Row, StructType


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: list[str]


def file_system(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Writer(DataSourceWriter):
    def __init__(self, path: str):
        self.path, self.job = path.rstrip("/"), uuid.uuid4().hex

    def write(self, iterator: Iterator[Row]) -> Written:
        system, root = file_system(self.path)
        folder = f"{root}/_temporary/{self.job}/{uuid.uuid4().hex}"
        names = []
        for row in iterator:
            name = row.path
            if not name or name.startswith("/") or ".." in name.split("/"):
                raise ValueError(f"no path below the folder: {name!r}")
            system.create_dir(f"{folder}/{name}".rpartition("/")[0], recursive=True)
            with system.open_output_stream(f"{folder}/{name}") as out:
                out.write(bytes(row.content))
            names.append(name)
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.path)
        done = [m for m in messages if m is not None]
        every = [n for m in done for n in m.names]
        if len(set(every)) < len(every):
            self.abort(messages)
            raise ValueError("two rows have one path")
        for m in done:
            for name in m.names:
                system.create_dir(f"{root}/{name}".rpartition("/")[0], recursive=True)
                system.move(f"{m.folder}/{name}", f"{root}/{name}")
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.path)
        from pyarrow import fs

        if system.get_file_info(f"{root}/_temporary/{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_temporary/{self.job}")
        if system.get_file_info(f"{root}/_temporary").type == fs.FileType.Directory and not system.get_file_info(fs.FileSelector(f"{root}/_temporary")):
            system.delete_dir(f"{root}/_temporary")


class NamedFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "named_files"

    def schema(self) -> str:
        return "path string, content binary"

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        return Writer(self.options["path"])


def written(df: DataFrame, path: str) -> None:
    """Each row of path, content as a file below the folder."""
    df.sparkSession.dataSource.register(NamedFiles)
    df.select("path", "content").write.format("named_files").mode("append").save(path)
