"""Small helpers the operators of this subpackage share."""

from __future__ import annotations

import contextlib
import ctypes
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a text table that one Arrow batch of a Python stage holds (long texts stay few per batch).
BATCH_ROWS = 1000
# Characters of a text that one call of a regular expression reads.
PIECE = 1 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict | None], schema: dict[str, str]) -> DataFrame:
    """Apply ``fn`` to each Arrow batch of ``df``; it returns the columns of the output batch.

    One task keeps one batch at a time, so memory does not grow with the partition.
    """
    names = list(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and len(out[names[0]]):
                    yield pa.RecordBatch.from_arrays([as_array(out[n]) for n in names], names=names)

    return df.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in schema.items()))


def giving_back(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for ``mapInArrow``, after which its Python worker, which stays for later tasks, returns freed memory to the system."""

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only in the GNU C library
            ctypes.CDLL(None).malloc_trim(0)

    return mapped


def as_array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list:
    return batch.column(batch.schema.get_field_index(column)).to_pylist()


def held_out(doc_id, folds: int, fold: int):
    """crc32 of the id written as text, modulo ``folds``, equals ``fold``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds == fold


def lower_ascii(text: str | None) -> str:
    """The text with A-Z alone in lower case; null is empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")


def pieces(text: str, inside: re.Pattern, size: int = PIECE) -> Iterator[str]:
    """``text`` in parts of about ``size`` characters, cut where no match of the character class ``inside`` is cut."""
    at = 0
    while at < len(text):
        end = min(at + size, len(text))
        while end < len(text) and inside.match(text[end]) and inside.match(text[end - 1]):
            run = inside.match(text, end)
            end = run.end()
        yield text[at:end]
        at = end
