"""Files that appear all together: a writer whose files count only once its manifest is committed."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

MANIFEST = "name string, place string, size bigint"


@dataclass
class Written(WriterCommitMessage):
    """A task's list of files, itself a file, so that a commit holds one line for each task."""

    manifest: str


class CommittedWriter(DataSourceWriter):
    def __init__(self, path: str, name: str, content: str):
        self.path, self.name, self.content, self.run = path, name, content, uuid.uuid4().hex

    def store(self):
        from pyarrow import fs

        return fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator[Row]) -> WriterCommitMessage:
        store, path = self.store()
        own = f"{path}/data/{self.run}/{uuid.uuid4().hex}"  # an attempt's own folder
        store.create_dir(own, recursive=True)
        lines = []
        for n, row in enumerate(iterator):
            if row[self.name] is None:
                continue
            content = bytes(row[self.content] or b"")
            with store.open_output_stream(f"{own}/{n}", compression=None) as out:
                out.write(content)
            lines.append(json.dumps({"name": row[self.name], "place": f"{own}/{n}"[len(path) + 1 :], "size": len(content)}))
        with store.open_output_stream(f"{own}/files.json", compression=None) as out:
            out.write("".join(x + "\n" for x in lines).encode())
        return Written(f"{own}/files.json")

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, path = self.store()
        store.create_dir(f"{path}/commits", recursive=True)
        with store.open_output_stream(f"{path}/commits/.{self.run}", compression=None) as out:
            out.write("".join(m.manifest[len(path) + 1 :] + "\n" for m in messages if m).encode())
        store.move(f"{path}/commits/.{self.run}", f"{path}/commits/{self.run}.txt")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, path = self.store()
        from pyarrow import fs

        if store.get_file_info(f"{path}/data/{self.run}").type != fs.FileType.NotFound:
            store.delete_dir(f"{path}/data/{self.run}")


class CommittedFiles(DataSource):
    """``df.write.format("committed").mode("append").option("path", folder).save()``, after ``spark.dataSource.register``.

    Options: path (a URI of a folder that all executors share), name and content (columns; ``file_name`` and ``content``).
    Rows without a name are left out. A write that fails leaves nothing that ``committed`` shows.
    """

    @classmethod
    def name(cls) -> str:
        return "committed"

    def schema(self) -> str:
        return "file_name string, content binary"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        if overwrite:
            raise ValueError("committed files are only added to: use mode append")
        return CommittedWriter(self.options["path"].rstrip("/"), self.options.get("name", "file_name"), self.options.get("content", "content"))


def committed(spark: SparkSession, folder: str) -> DataFrame:
    """name, place, size and commit of all files of committed writes; empty if there is none."""
    folder = folder.rstrip("/")
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/commits")
    store = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(p) or not [1 for f in store.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/commits/*.txt"))]:
        return spark.createDataFrame([], f"{MANIFEST}, commit string")
    commits = spark.read.text(f"{folder}/commits/*.txt").select(F.col("value").alias("manifest"), F.regexp_extract(F.input_file_name(), r"([0-9a-f]+)\.txt$", 1).alias("commit"))
    lists = spark.read.schema(MANIFEST).json(f"{folder}/data/*/*/files.json").select("*", F.regexp_extract(F.input_file_name(), r"(data/[0-9a-f]+/[0-9a-f]+/files\.json)$", 1).alias("manifest"))
    return lists.join(commits, "manifest").select("name", "place", "size", "commit")


def contents(spark: SparkSession, folder: str) -> DataFrame:
    """name and content of committed files; of a name that was written more than once, that of the largest commit id."""
    files = committed(spark, folder)
    last = files.groupBy("name").agg(F.max_by(F.struct("place", "size"), "commit").alias("f")).select("name", "f.place", "f.size")
    found = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/data/*/*/[0-9]*").select(F.regexp_extract("path", r"(data/[0-9a-f]+/[0-9a-f]+/[0-9]+)$", 1).alias("place"), "content")
    # the scan passes over files without a byte
    return last.join(found, "place", "left").select("name", F.coalesce("content", F.when(F.col("size") == 0, F.lit("").cast("binary"))).alias("content"))
