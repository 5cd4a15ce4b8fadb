"""Page images as columns of gray values: preparation before recognition, recognition page by page, and search for a template.

An image is a row with ``pixels`` (gray values 0 to 255, row by row) and ``width``. Preparation is native; recognition
takes a pluggable function; the search is numpy within a task's batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X

#: Fixed value: gray values below it become black before recognition.
THRESHOLD = 170
#: How alike a place must be, the sizes in which a template is sought, and its least side.
ALIKE, SCALES, LEAST_SIDE = 0.65, (0.5, 0.75, 1.0, 1.25), 20


def autocontrast(pixels: Column, cutoff: float = 0.0) -> Column:
    """Gray values stretched to 0..255, ``cutoff`` percent of them ignored at either end; an image of one gray stays as it is."""
    cut = F.floor(F.size(pixels) * cutoff / 100).cast("int")
    ends = X.let(F.sort_array(pixels), lambda s: F.struct(F.get(s, cut).alias("low"), F.get(s, F.size(s) - 1 - cut).alias("high")))

    def stretched(e: Column) -> Column:
        scale = F.lit(255.0) / (e["high"] - e["low"])
        wide = F.transform(pixels, lambda p: F.greatest(F.lit(0), F.least(F.lit(255), (p * scale - e["low"] * scale).cast("int"))))
        return F.when(e["high"] > e["low"], wide).otherwise(F.transform(pixels, lambda p: p.cast("int")))

    return X.let(ends, lambda e: F.when(e["high"].isNotNull(), stretched(e)).otherwise(F.transform(pixels, lambda p: p.cast("int"))))


def bilevel(pixels: Column, threshold: int = THRESHOLD) -> Column:
    """Black below the threshold, white from it on."""
    return F.transform(pixels, lambda p: F.when(p < threshold, 0).otherwise(255))


def prepared(images: DataFrame, cutoff: float = 0.0) -> DataFrame:
    """Images as recognition wants them: stretched, then black and white."""
    return images.withColumn("pixels", bilevel(autocontrast(F.col("pixels"), cutoff)))


def recognised_pages(images: DataFrame, recognise: Callable[[np.ndarray], str], key: str, most: int = 3) -> DataFrame:
    """(key, ocr_text) of files: the texts of their first ``most`` pages (page_no), each with a line end, in order.

    ``recognise``: a prepared page as a 2-d array to its text; a page that it fails on has none.
    """
    def one(pixels, width) -> str:
        try:
            return recognise(np.asarray(pixels.values, np.uint8).reshape(-1, width.as_py())) or ""
        except Exception:
            return ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([one(p, w) for p, w in zip(batch.column(2), batch.column(3))], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), texts], names=[key, "page_no", "_text"])

    wanted = prepared(images.where(F.col("page_no") <= most)).select(key, F.col("page_no").cast("int"), "pixels", F.col("width").cast("int"))
    pages = wanted.mapInArrow(read, f"{key} {images.schema[key].dataType.simpleString()}, page_no int, _text string")
    texts = F.sort_array(F.collect_list(F.struct("page_no", "_text")))  # a few pages of a file
    return pages.groupBy(key).agg(F.array_join(F.transform(texts, lambda p: F.concat(p["_text"], F.lit("\n"))), "").alias("ocr_text"))


def likeness(page: np.ndarray, template: np.ndarray) -> float:
    """The greatest normalised correlation of a template with a place of a page; sums over places come from running sums."""
    h, w = template.shape
    small = template - template.mean()
    size = [page.shape[0] + h, page.shape[1] + w]
    cross = np.fft.irfft2(np.fft.rfft2(page, size) * np.fft.rfft2(small[::-1, ::-1], size), size)[h - 1 : page.shape[0], w - 1 : page.shape[1]]
    sums = [np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (page, page * page)]
    one, two = (s[h:, w:] - s[:-h, w:] - s[h:, :-w] + s[:-h, :-w] for s in sums)
    spread = (two - one * one / (h * w)) * (small * small).sum()
    return float(np.where(spread > 1e-6, cross / np.sqrt(np.maximum(spread, 1e-6)), 0.0).max())


def resized(template: np.ndarray, scale: float) -> np.ndarray:
    h, w = int(template.shape[0] * scale), int(template.shape[1] * scale)
    return template[np.minimum((np.arange(h) / scale).astype(int), template.shape[0] - 1)][:, np.minimum((np.arange(w) / scale).astype(int), template.shape[1] - 1)]


def holding(images: DataFrame, template: np.ndarray, key: str, least: float = ALIKE, scales: tuple[float, ...] = SCALES) -> DataFrame:
    """(key, found): whether an image holds a gray template in one of several sizes. Images without pixels hold nothing."""
    sizes = [t for t in (resized(np.asarray(template, float), s) for s in scales) if min(t.shape) >= LEAST_SIDE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for pixels, width in zip(batch.column(1), batch.column(2).to_pylist()):
                flat = np.asarray(pixels.values, float) if pixels.is_valid and width else np.empty(0)
                page = flat.reshape(-1, width) if len(flat) else np.empty((0, 0))
                found.append(any(t.shape[0] <= page.shape[0] and t.shape[1] <= page.shape[1] and likeness(page, t) > least for t in sizes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.bool_())], names=[key, "found"])

    kind = images.schema[key].dataType.simpleString()
    return images.select(key, F.col("pixels").cast("array<int>"), F.col("width").cast("int")).mapInArrow(run, f"{key} {kind}, found boolean")
