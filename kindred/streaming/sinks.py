"""A row-by-row sink for streams whose repeated batches leave every row once."""

from __future__ import annotations

import json

from pyarrow import fs
from pyspark.sql import DataFrame, Row

from kindred.session import work_dir


class JsonRows:
    """Writes the rows of every (partition, epoch) to one file of JSON lines in a folder that all executors reach.

    Rows go to a file of their own attempt, which takes its final name when the partition is done. A final name that is
    there already means that an earlier attempt came through: its rows are not written again.
    """

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def open(self, partition_id: int, epoch_id: int) -> bool:
        self._files, root = fs.FileSystem.from_uri(self.folder)
        self._files.create_dir(root, recursive=True)
        self._final = f"{root}/epoch={epoch_id}-part={partition_id}.json"
        self._rows: list[str] = []
        self._own, self._out = None, None
        return self._files.get_file_info(self._final).type == fs.FileType.NotFound

    def process(self, row: Row) -> None:
        if self._out is None:
            self._own = f"{self._final}.{id(self):x}.open"
            self._out = self._files.open_output_stream(self._own)
        self._out.write((json.dumps(row.asDict(recursive=True), default=str) + "\n").encode())

    def close(self, error: Exception | None) -> None:
        if self._out is not None:
            self._out.close()
            if error is None:
                self._files.move(self._own, self._final)
            else:
                self._files.delete_file(self._own)


def run_rows(df: DataFrame, folder: str, checkpoint: str | None = None, **options) -> None:
    """Append-mode run over the files present now, row by row into :class:`JsonRows`."""
    writer = df.writeStream.foreach(JsonRows(folder)).outputMode("append").trigger(availableNow=True).queryName(f"rows_{folder.rsplit('/', 1)[-1]}")
    writer.options(checkpointLocation=checkpoint or work_dir(df.sparkSession), **options).start().awaitTermination()
