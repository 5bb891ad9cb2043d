"""A print sink whose tasks write the lines, once for each batch however often it is run.

A task writes its lines to a file of its own attempt and tells the driver its name only. When all tasks of a
batch are done, the named files move to the batch's folder, and a mark there says that it is whole. A batch
that is run again finds the mark and drops what it wrote; files of failed attempts are never named.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Row
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

STAGED, DONE = "_staged", "_done"  # readers skip names that begin so


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


@dataclass
class Written(WriterCommitMessage):
    name: str
    rows: int


class PrintWriter(DataSourceStreamWriter):
    def __init__(self, folder: str, sep: str, echo: bool):
        self.folder, self.sep, self.echo = folder, sep, echo

    def write(self, rows: Iterator[Row]) -> Written:
        part = TaskContext.get().partitionId()
        name = f"part-{part:05d}-{uuid.uuid4().hex}.txt"
        store, root = filesystem(self.folder)
        store.create_dir(f"{root}/{STAGED}", recursive=True)
        n = 0
        with store.open_output_stream(f"{root}/{STAGED}/{name}") as out:
            for row in rows:
                line = self.sep.join("null" if v is None else str(v) for v in row)
                out.write(f"{line}\n".encode())
                if self.echo:
                    print(f"{part}> {line}")
                n += 1
        return Written(name, n)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        store, root = filesystem(self.folder)
        batch = f"{root}/batch={batchId}"
        if store.get_file_info(f"{batch}/{DONE}").type != fs.FileType.NotFound:
            return self.abort(messages, batchId)
        if store.get_file_info(batch).type != fs.FileType.NotFound:  # a commit that ended half way
            store.delete_dir(batch)
        store.create_dir(batch, recursive=True)
        for message in filter(None, messages):
            store.move(f"{root}/{STAGED}/{message.name}", f"{batch}/{message.name}")
        store.open_output_stream(f"{batch}/{DONE}").close()

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        store, root = filesystem(self.folder)
        for message in filter(None, messages):
            store.delete_file(f"{root}/{STAGED}/{message.name}")


class Printed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "printed_lines"

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return PrintWriter(self.options["folder"], self.options.get("sep", ","), self.options.get("echo") == "true")
