"""One JSON file a document: a sink whose tasks write and whose commit makes all files visible at once.

df.write.format("json_documents").mode("append").save(path) takes rows (name, json) and leaves
path/run-<time>-<id>/<task>/<name>.json. Tasks write below a hidden folder; the commit drops
what failed attempts left there and renames it, so readers see all documents of a run or none.
A document that is written again is read from its latest run.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from silverloom.sources.files import file_name


def opened(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder that all machines share (a mounted path, hdfs, s3, gs) and its path there."""
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "/", re.sub(r"^s3[an]://", "s3://", folder)))


@dataclass
class Written(WriterCommitMessage):
    folder: str
    documents: int


class JsonDocuments(DataSource):
    """Columns name, the file's name without '.json', and json, its text; a null or empty text is the JSON null. Names mustn't hold '/'."""

    @classmethod
    def name(cls) -> str:
        return "json_documents"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("documents are added; one that is written again replaces the earlier one when it is read")
        if [f.name for f in schema.fields] != ["name", "json"]:
            raise ValueError(f"columns must be name and json, not {schema.names}")
        return DocumentWriter(self.options["path"])


class DocumentWriter(DataSourceWriter):
    def __init__(self, path: str) -> None:
        self.path, self.run = path, f"run-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"

    def write(self, rows: Iterator[Row]) -> Written:
        fs, root = opened(self.path)
        folder, n = uuid.uuid4().hex, 0
        for name, text in rows:
            if not name or "/" in name:
                raise ValueError(f"not a file's name: {name!r}")
            if not n:
                fs.create_dir(f"{root}/.{self.run}/{folder}", recursive=True)
            with fs.open_output_stream(f"{root}/.{self.run}/{folder}/{name}.json") as out:
                out.write((text or "null").encode())
            n += 1
        return Written(folder, n)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        whole = {m.folder for m in messages if m and m.documents}
        if not whole:
            return self.abort(messages)
        for info in fs.get_file_info(pafs.FileSelector(f"{root}/.{self.run}")):
            if info.base_name not in whole:
                fs.delete_dir(info.path)
        fs.move(f"{root}/.{self.run}", f"{root}/{self.run}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = opened(self.path)
        if fs.get_file_info(f"{root}/.{self.run}").type != pafs.FileType.NotFound:
            fs.delete_dir(f"{root}/.{self.run}")


def write_documents(docs: DataFrame, path: str) -> None:
    """Write rows (name, json); Spark's tasks write the files."""
    docs.sparkSession.dataSource.register(JsonDocuments)
    docs.select(F.col("name").cast("string").alias("name"), F.col("json").cast("string").alias("json")).write.format("json_documents").mode("append").save(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(name, json) of all documents, each from its latest run; none if there is no folder."""
    fs, root = opened(path)
    if not fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        return spark.createDataFrame([], "name string, json string")
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    files = files.select(F.regexp_extract("_metadata.file_path", r"/(run-[^/]+)/[^/]+/[^/]+$", 1).alias("run"), F.regexp_replace(file_name(), r"\.json$", "").alias("name"), F.col("value").alias("json"))
    latest = F.row_number().over(Window.partitionBy("name").orderBy(F.desc("run")))
    return files.withColumn("n", latest).where("n = 1").select("name", "json")
