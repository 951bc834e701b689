"""Landed files: one for each row, written in the tasks."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def file_system(directory: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder and the folder's path in it, local folders in any of their spellings."""
    local = re.match(r"(?:file:/*)?(/[^/].*)", re.sub(r"^file:/+", "file:/", directory).replace("file:", ""))
    return (fs.LocalFileSystem(), local[1]) if local else fs.FileSystem.from_uri(directory)


def land_files(rows: DataFrame, directory: str, name: str = "name", content: str = "content") -> None:
    """A file in the folder for each row, by its name, with its content in UTF-8; null is an empty file.

    A file is written under another name and then moved, so that it is whole once it is there, and a task that runs
    again writes the same files.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        files, path = file_system(directory)
        files.create_dir(path)
        for b in batches:
            for own, text in zip(b["name"], b["content"], strict=True):
                draft = f"{path}/_{uuid.uuid4().hex}"
                with files.open_output_stream(draft) as f:
                    f.write(text.encode("utf-8"))
                files.move(draft, f"{path}/{own}")
            yield pd.DataFrame({"n": [len(b)]})

    out = rows.select(F.col(name).alias("name"), F.coalesce(content, F.lit("")).alias("content")).mapInPandas(run, "n long")
    out.write.format("noop").mode("overwrite").save()
