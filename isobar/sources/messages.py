"""Messages of large files, read by ranges that an index tells: other bytes of a file are never read."""

from __future__ import annotations

import bz2
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.grids import byte_ranges
from .catalog import first_message, index_lines
from .packs import opened


def read_ranges(ranges: DataFrame, path: str = "path", start: str = "offset", end: str = "range_end") -> DataFrame:
    """ranges with content (the bytes from start to end, both included; to the file's end where end is null) and error.

    Each range is read by itself where its row lies: rows are dealt by file and place, so a file's messages are read by many
    tasks. A range in a file that can't be read has null content and what went wrong.
    """
    names = ranges.columns
    kinds = ", ".join(f"`{c}` {k}" for c, k in ranges.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):  # a batch holds few messages at once
                part = b.slice(i, 64)
                content, errors = [], []
                for file, first, last in zip(*(part.column(names.index(c)).to_pylist() for c in (path, start, end)), strict=True):
                    try:
                        system, at = opened(file.removeprefix("file://") if file.startswith("file:///") else file.removeprefix("file:"))
                        with system.open_input_file(at) as f:
                            f.seek(first)
                            content.append(f.read() if last is None else f.read(max(last - first + 1, 0)))
                        errors.append(None)
                    except (OSError, ValueError, TypeError) as error:
                        content.append(None)
                        errors.append(f"{type(error).__name__}: {error}"[:500])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(content, pa.binary()), pa.array(errors, pa.string())], names=[*names, "content", "error"])

    return ranges.repartition(path, start).mapInArrow(run, f"{kinds}, content binary, error string")


def indexed_messages(spark: SparkSession, index: str, wanted: list[list[str]], suffix: str = ".idx") -> DataFrame:
    """path, number, offset, range_end, description, asked, content and error: of every file with an index (its name and suffix,
    below the path or pattern index) the first message that holds all tokens of each list of wanted (asked is its number)."""
    lines = spark.read.text(index).select(F.regexp_replace(F.col("_metadata.file_path"), f"{suffix.replace('.', '[.]')}$", "").alias("path"), F.col("value").alias("line"))
    ranged = byte_ranges(index_lines(lines, ["path"]), ["path"], "offset", "offset")
    found = None
    for k, tokens in enumerate(wanted):
        one = first_message(ranged, ["path"], tokens).withColumn("asked", F.lit(k))
        found = one if found is None else found.unionByName(one)
    return read_ranges(found)


def unpacked_payloads(spark: SparkSession, path: str) -> DataFrame:
    """path, content and error of files as they are, or bz2 decoded where their name ends so; a faulty one has null content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    row = (name, bz2.decompress(data) if name.endswith(".bz2") else data, None)
                except (OSError, ValueError) as error:
                    row = (name, None, str(error))
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, (pa.string(), pa.binary(), pa.string()), strict=True)], names=["path", "content", "error"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, content binary, error string")


def joined_parameters(cells: DataFrame, expected: DataFrame, by: list[str], parameter: str, cell: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """One grid of files that hold one parameter each, and what became of every parameter.

    cells: by, parameter, cell and value, from as many files as there are parameters; expected: by and parameter. First: by,
    cell and a map of the parameters' values at it. Second: by, parameter and status, `ok` or `missing`. A parameter that is
    missing leaves the others as they are.
    """
    grid = cells.join(expected.select(*by, parameter).distinct(), [*by, parameter], "left_semi").groupBy(*by, *cell).agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct(parameter, value)))).alias("fields"))
    seen = cells.select(*by, parameter, F.lit(True).alias("_seen")).distinct()
    status = expected.join(seen, [*by, parameter], "left").select(*by, parameter, F.when(F.col("_seen"), "ok").otherwise("missing").alias("status"))
    return grid, status
