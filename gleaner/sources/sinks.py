"""Sinks: tables, reports of several sheets, spreadsheets, text dumps, files by name, and progress."""

from __future__ import annotations

import importlib.util

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_report(sheets: dict[str, DataFrame], folder: str, kind: str = "parquet") -> None:
    """One folder per sheet; fills and highlights are columns of the sheet (see the fill functions)."""
    for name, df in sheets.items():
        df.write.mode("overwrite").option("header", "true").format(kind).save(f"{folder}/{name}")


def write_workbook(sheets: dict[str, DataFrame], path: str, most: int = 1_048_575, fill: str = "row_fill") -> None:
    """An .xlsx of the sheets, where openpyxl is installed; rows with a fill are coloured. A sheet's own row limit is checked."""
    if importlib.util.find_spec("openpyxl") is None:
        raise RuntimeError("openpyxl isn't installed; write_report writes the same sheets as tables")
    from openpyxl import Workbook
    from openpyxl.styles import PatternFill

    book = Workbook()
    book.remove(book.active)
    for name, df in sheets.items():
        if df.limit(most + 1).count() > most:
            raise ValueError(f"sheet {name} has more than {most} rows; write it with write_report")
        columns = [c for c in df.columns if c != fill]
        sheet = book.create_sheet(name)
        sheet.append(columns)
        sheet.freeze_panes = "A2"
        for row in df.toLocalIterator():
            sheet.append([row[c] for c in columns])
            if fill in df.columns and row[fill]:
                for cell in sheet[sheet.max_row]:
                    cell.fill = PatternFill(start_color=row[fill], end_color=row[fill], fill_type="solid")
    book.save(path)


def write_texts(df: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Raw texts for inspection, keyed by id."""
    df.select(F.to_json(F.struct(id_col, text_col)).alias("value")).write.mode("overwrite").text(folder)


def write_files(df: DataFrame, folder: str, name_col: str = "file_name", content_col: str = "content") -> None:
    """Files under derived names, through the file system of the folder's URI, each renamed into place when complete."""

    def save(rows) -> None:
        import uuid

        from pyarrow import fs

        store, path = fs.FileSystem.from_uri(folder)
        store.create_dir(path, recursive=True)
        for row in rows:
            if row[name_col] is not None:
                part = f"{path}/.{row[name_col]}.{uuid.uuid4().hex}.part"  # attempts that run at once don't share it
                with store.open_output_stream(part, compression=None) as out:
                    out.write(bytes(row[content_col] or b""))
                store.move(part, f"{path}/{row[name_col]}")

    df.select(name_col, content_col).foreachPartition(save)


def append_progress(df: DataFrame, path: str) -> None:
    """Add results to the progress table; rows are only ever added."""
    df.write.mode("append").parquet(path)


def read_progress(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The progress table, empty if there is none yet."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def clear_progress(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
