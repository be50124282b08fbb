"""JSON objects that span lines, read by as many tasks as the files have splits.

The reader for multi-line JSON takes a whole file in one task. Here files are read as lines,
which Spark splits, and objects are cut out by the depth of their braces. JSON strings hold
no line feeds, so every line starts outside of one and its braces can be told from those in
strings without knowing what came before. What came before decides the depth only:

* Each split sums up the depth its lines add, and the lowest point they reach. Depth cannot
  fall below zero, so entering at depth d a split ends at ``max(d + total, total - lowest)``;
  these two numbers a split give the depth at which every split begins. Splits that are a
  whole file begin at zero and are not summed up.
* From there a task walks through the lines of its splits and cuts where the depth leaves or
  reaches zero. An object that ends in the split it begins in is done.
* Pieces of the others, two a split at most, meet by the number of objects that splits
  before them left unfinished.

Only those pieces and two numbers a split are shuffled; lines stay in the task that reads
them, in their order. A line is not split, so one that holds everything is one task's work.
Text between objects other than brackets and commas, and an object that never ends, come
out as malformed records.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

FILE, SPLIT = "_object_file", "_object_split"
_LINE, _WHOLE = "_object_line", "_object_whole"
# Strings, also one that the line breaks off; a backslash takes no line separator with it.
_STRING = rb'"(?:[^"\\]|\\(?!\xc2\x85|\xe2\x80[\xa8\xa9])[^\r\n])*"?'
# Strings, single braces, and all between them.
_TOKENS = _STRING + rb'|[{}]|[^"{}]+'
_BETWEEN = rb"[ \t\n\x0b\f\r,\[\]]*(?:\xc2\x85|\xe2\x80[\xa8\xa9])?\Z"
# An object or text between objects; pieces of an object that other splits have a part of,
# the split's first lines or its last.
_DONE, _REST, _BEGUN = 0, 1, 2


def object_lines(lines: DataFrame) -> DataFrame:
    """The lines of a text source, batch or stream, with the file and split they are of."""
    split = F.col("_metadata.file_block_start")
    return lines.select(
        F.col("_metadata.file_path").alias(FILE),
        split.alias(SPLIT),
        ((split == 0) & (F.col("_metadata.file_block_length") == F.col("_metadata.file_size"))).alias(_WHOLE),
        F.col("value").alias(_LINE),
    )


def cut_objects(lines: DataFrame) -> DataFrame:
    """``_object_file, text``: the objects in the lines of :func:`object_lines`, a batch,
    as the tasks read them.

    Objects may hold others. The order of objects is not kept.
    """
    shared = lines.where(~F.col(_WHOLE))
    # Few: files of several splits only, and of these the splits that cut an object.
    splits = F.broadcast(_open_splits(shared))
    made = f"{FILE} string, {SPLIT} long, kind int, text string"
    done = lines.join(splits, [FILE, SPLIT], "left").mapInArrow(_cutter(), made).where(F.col("kind") == _DONE)
    pieces = shared.join(splits, [FILE, SPLIT]).mapInArrow(_cutter(), made).where(F.col("kind") != _DONE)
    before = Window.partitionBy(FILE).orderBy(SPLIT, "kind").rowsBetween(Window.unboundedPreceding, 0)
    pieces = pieces.withColumn("number", F.sum((F.col("kind") == _BEGUN).cast("long")).over(before))
    joined = pieces.groupBy(FILE, "number").agg(F.sort_array(F.collect_list(F.struct(SPLIT, "kind", "text"))).alias("pieces"))
    return done.select(FILE, "text").union(joined.select(FILE, F.array_join("pieces.text", "\n").alias("text")))


def _open_splits(lines: DataFrame) -> DataFrame:
    """``_object_file, _object_split, _enter``: the depth at which splits begin that begin
    or end inside of an object."""
    sums = lines.mapInArrow(_summer(), f"{FILE} string, {SPLIT} long, _total long, _lowest long")
    earlier = Window.partitionBy(FILE).orderBy(SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("_start", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
    lowest = F.coalesce(F.min(F.col("_start") + F.col("_lowest")).over(earlier), F.lit(0))
    sums = sums.withColumn("_enter", F.col("_start") - F.least(lowest, F.lit(0)))
    leaves = F.greatest(F.col("_enter") + F.col("_total"), F.col("_total") - F.col("_lowest"))
    return sums.where((F.col("_enter") > 0) | (leaves > 0)).select(FILE, SPLIT, "_enter")


# What follows runs in tasks. Functions inside of functions go there by value, so workers
# need not have this package.


def _walker() -> Callable[[pa.RecordBatch], Iterator[tuple[tuple[str, int], int, int]]]:
    """Gives the ranges of a batch's rows that are of one split."""

    def ranges(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
        files, splits = batch.column(FILE), batch.column(SPLIT)
        n = batch.num_rows
        new = np.ones(n, dtype=bool)
        for column in (files, splits):
            same = pc.equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            new[1:] &= same.astype(bool)
        starts = np.concatenate([[0], np.flatnonzero(~new[1:]) + 1])
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), n], strict=True):
            yield (files[lo].as_py(), splits[lo].as_py()), lo, hi

    return ranges


def _summer():
    """For each split the depth its lines add and the lowest point they reach, at most 0."""
    ranges = _walker()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        string = re.compile(_STRING)
        sums: dict[tuple[str, int], tuple[int, int]] = {}
        for batch in (b for b in batches if b.num_rows):
            texts = batch.column(_LINE).cast(pa.large_binary())
            braces = pc.match_substring_regex(texts, "[{}]").to_numpy(zero_copy_only=False)
            for place, lo, hi in ranges(batch):
                at, low = sums.get(place, (0, 0))
                for k in np.flatnonzero(braces[lo:hi]).tolist():
                    for c in string.sub(b"", texts[lo + k].as_py()):
                        if c == 123:
                            at += 1
                        elif c == 125:
                            at -= 1
                            low = min(low, at)
                sums[place] = at, low
        if sums:
            rows = [(*place, *found) for place, found in sums.items()]
            columns = [pa.array(x) for x in zip(*rows, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=[FILE, SPLIT, "_total", "_lowest"])

    return run


def _cutter():
    """The objects of splits that begin at the depth ``_enter``, or zero, and the pieces."""
    ranges = _walker()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, between = re.compile(_TOKENS), re.compile(_BETWEEN)
        out: list[tuple[str, int, int, bytes]] = []
        place, whole, depth, kind = None, True, 0, _DONE
        held: list[bytes] = []  # lines of the object that is open

        def stray(text: bytes) -> None:
            if not between.match(text):
                out.append((*place, _DONE, text))

        def end() -> None:
            if depth:
                out.append((*place, _DONE if whole else kind or _BEGUN, b"\n".join(held)))

        def made() -> pa.RecordBatch:
            files, splits, kinds, found = zip(*out, strict=True)
            out.clear()
            columns = [pa.array(files), pa.array(splits, pa.int64()), pa.array(kinds, pa.int32())]
            columns.append(pa.array(found, pa.binary()).view(pa.string()))
            return pa.RecordBatch.from_arrays(columns, names=[FILE, SPLIT, "kind", "text"])

        for batch in (b for b in batches if b.num_rows):
            texts = batch.column(_LINE).cast(pa.large_binary())
            braces = pc.match_substring_regex(texts, "[{}]").to_pylist()
            lines = texts.to_pylist()
            for here, lo, hi in ranges(batch):
                if here != place:
                    end()
                    place, whole, held = here, batch.column(_WHOLE)[lo].as_py(), []
                    depth = batch.column("_enter")[lo].as_py() or 0
                    kind = _REST if depth else _DONE
                for line, some in zip(lines[lo:hi], braces[lo:hi], strict=True):
                    if not some:
                        if depth:
                            held.append(line)
                        else:
                            stray(line)
                        continue
                    text: list[bytes] = []
                    for token in tokens.findall(line):
                        if token == b"{":
                            if not depth:
                                stray(b"".join(text))
                                text, held, kind = [], [], _DONE
                            depth += 1
                        elif token == b"}" and depth:
                            depth -= 1
                            if not depth:
                                held.append(b"".join(text) + token)
                                out.append((*place, kind, b"\n".join(held)))
                                text, held, kind = [], [], _DONE
                                continue
                        text.append(token)
                    if depth:
                        held.append(b"".join(text))
                    else:
                        stray(b"".join(text))
            if out:
                yield made()
        end()
        if out:
            yield made()

    return run


def parse_objects(objects: DataFrame, schema: StructType, corrupt_column: str | None = None) -> DataFrame:
    """The columns of a schema from the texts of :func:`cut_objects`, and the file.

    What is no object of that shape stands in ``corrupt_column``, if the schema has it.
    """
    options = {"mode": "PERMISSIVE"} | ({"columnNameOfCorruptRecord": corrupt_column} if corrupt_column else {})
    parsed = objects.select(FILE, F.from_json("text", schema, options).alias("_object"))
    return parsed.select(*[F.col("_object")[f.name].alias(f.name) for f in schema], FILE)


def read_objects(
    spark: SparkSession,
    path: str,
    schema: StructType,
    name_pattern: str | None = None,
    recursive: bool = True,
    corrupt_column: str | None = None,
) -> DataFrame:
    """The objects of multi-line files, as a batch whose tasks share large files."""
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if name_pattern:
        reader = reader.option("pathGlobFilter", name_pattern)
    objects = cut_objects(object_lines(reader.format("text").load(path)))
    return parse_objects(objects, schema, corrupt_column).drop(FILE)


def stream_lines(
    spark: SparkSession,
    path: str,
    name_pattern: str | None = None,
    recursive: bool = True,
    archive_path: str | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: str | None = None,
) -> DataFrame:
    """The landing files as a stream of lines; cut each micro-batch, which has whole files."""
    reader = spark.readStream.format("text").option("recursiveFileLookup", str(recursive).lower())
    named = {
        "pathGlobFilter": name_pattern,
        "maxFilesPerTrigger": max_files_per_trigger,
        "maxBytesPerTrigger": max_bytes_per_trigger,
        "sourceArchiveDir": archive_path,
        "cleanSource": "archive" if archive_path else None,
    }
    return object_lines(reader.options(**{k: v for k, v in named.items() if v is not None}).load(path))
