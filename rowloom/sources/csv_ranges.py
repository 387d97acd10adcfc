"""CSV with line breaks in quoted cells, read by all tasks that a file's byte ranges give.

Spark cuts a text file into byte ranges and lines, but a line break inside of quotes does not end a record. So
the ranges are read twice. First every range says, for both ways in which it may begin (at a record, inside of
quotes), in which of them it ends; a running composition of these answers, range after range, tells how each
range really begins. Then all ranges are cut into records at the same time. A record that reaches over the
end of its range comes in pieces, at most two of each range, which are put together by their place in the file.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows of a file have ids from its number in the order of paths times this on, plus their place in the file.
FILE_STEP = 1 << 44

# A cell in quotes with what follows up to the separator, or a plain one. No part gives characters back once it has
# them, so a line is read once.
_INSIDE = r'(?:[^"]|"")*+'
_CLOSED = re.compile(rf'{_INSIDE}"[^,]*+')
_OPEN = re.compile(rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+)?+,)*+"{_INSIDE}\Z')


def ends_open(line: str, begins_open: bool) -> bool:
    """Whether a line ends inside of quotes. A quote opens only at the start of a cell."""
    if begins_open:
        closed = _CLOSED.match(line)
        if closed is None:
            return True
        if closed.end() == len(line):
            return False
        line = line[closed.end() + 1:]
    return _OPEN.match(line) is not None


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """((file, start of the range), lines) of every run of lines of one range."""
    for batch in batches:
        keys = np.stack([batch.column(1).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False)])
        cuts = [0, *(np.flatnonzero((np.diff(keys) != 0).any(axis=0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            if b > a:
                yield (int(keys[0, a]), int(keys[1, a])), batch.column(0).slice(a, b - a)


def _answers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For every range that has quotes how it ends if it begins at a record, and if it begins inside of quotes."""
    found: dict[tuple[int, int], list[bool]] = {}
    for key, lines in _blocks(batches):
        state = found.setdefault(key, [False, True])
        for line in lines.to_pylist():
            state[:] = [ends_open(line, s) for s in state]
    if found:
        yield pa.RecordBatch.from_pydict({
            "file": pa.array([f for f, _ in found], pa.int64()), "start": pa.array([s for _, s in found], pa.int64()),
            "if_closed": pa.array([a for a, _ in found.values()]), "if_open": pa.array([b for _, b in found.values()]),
        })


def _changes(answers: DataFrame) -> DataFrame:
    """(file, start, open): the ranges after which another state holds than before; a file begins at a record."""
    so_far = Window.partitionBy("file").orderBy("start")
    turns = F.sum((F.col("if_closed") & ~F.col("if_open")).cast("int")).over(so_far)
    # A range whose end does not depend on its beginning settles what came before; later ones may turn it around.
    fixed = F.when(F.col("if_closed") == F.col("if_open"), F.struct(F.col("if_closed").alias("open"), "turns"))
    after = answers.withColumn("turns", turns).withColumn("last", F.last(fixed, ignorenulls=True).over(so_far))
    odd = (F.col("turns") - F.coalesce(F.col("last.turns"), F.lit(0))) % 2 == 1
    after = after.select("file", "start", (F.coalesce(F.col("last.open"), F.lit(False)) != odd).alias("open"))
    before = F.coalesce(F.lag("open").over(so_far), F.lit(False))
    return after.withColumn("before", before).filter("open <> before").select("file", "start", "open")


def _state_at(changes: list[tuple[int, int, bool]], key: tuple[int, int]) -> bool:
    """Whether a range begins inside of quotes, from the changes in order."""
    i = bisect_left(changes, (*key, False)) - 1
    return i >= 0 and changes[i][0] == key[0] and changes[i][2]


def _cut(changes: list[tuple[int, int, bool]]):
    """The task of the second reading: lines to records (whole) and pieces of records."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, begins, number, held, at = None, True, 0, [], 0
        out: list[tuple[int, str, bool, bool]] = []

        def rows(places, texts, begin, end) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([
                pa.array(places, pa.int64()), pa.array(texts, pa.string()), pa.array(begin, pa.bool_()), pa.array(end, pa.bool_()),
            ], ["place", "text", "begins", "ends"])

        def flush(places=(), texts=None) -> Iterator[pa.RecordBatch]:
            """What has been found up to here, by place."""
            n = len(places)
            if out:
                places = np.concatenate([places, [x[0] for x in out]]).astype(np.int64)
                texts = [*(texts.to_pylist() if n else []), *(x[1] for x in out)]
                order = np.argsort(places, kind="stable")
                begin, end = (np.array([*[True] * n, *(x[i] for x in out)])[order] for i in (2, 3))
                yield rows(places[order], [texts[i] for i in order], begin, end)
                out.clear()
            elif n:
                yield rows(places, texts, np.ones(n, bool), np.ones(n, bool))

        for now, lines in _blocks(batches):
            if now != key:
                if held:
                    out.append((at, "\n".join(held), begins, False))
                key, held, number = now, [], 0
                begins = not _state_at(changes, now)
            first, n = now[0] * FILE_STEP + now[1] + number, len(lines)
            ends, state, done = np.zeros(n, bool), bool(held) or not begins, 0
            for i in np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist():
                ends[done:i] = not state
                state = ends_open(lines[i].as_py(), state)
                ends[i], done = not state, i + 1
            ends[done:] = not state
            starts = np.concatenate([[not held and begins], ends[:-1]])
            whole = starts & ends
            rest = np.flatnonzero(~whole)
            for i, line in zip(rest.tolist(), lines.take(pa.array(rest)).to_pylist()):
                if starts[i]:
                    begins = True
                if not held:
                    at = first + i
                held.append(line)
                if ends[i]:
                    out.append((at, "\n".join(held), begins, True))
                    held, begins = [], True
            number += n
            yield from flush(first + np.flatnonzero(whole), lines.filter(pa.array(whole)))
        if held:
            out.append((at, "\n".join(held), begins, False))
        yield from flush()

    return run


def records(spark: SparkSession, path: str) -> DataFrame:
    """(place, text): every record of the CSV files below a path, line breaks in quotes included, without their ends.

    A line break of two characters (CR, LF) counts as the one of one, also in quotes.

    ``place`` grows in the order of paths and, within a file, of records. Empty lines are no records.
    """
    plain = spark.read.option("lineSep", "\n").text(path)
    # Only names: a file's content is not read where its column is not asked for.
    names = sorted(r[0] for r in spark.read.format("binaryFile").load(path).select("_metadata.file_path").collect())
    if not names:
        return spark.createDataFrame([], "place long, text string")
    numbers = spark.createDataFrame(list(enumerate(names)), "file long, name string")
    by_hash = {r["h"]: r["file"] for r in numbers.select("file", F.xxhash64("name").alias("h")).collect()}
    if len(by_hash) < len(names):
        raise ValueError("two paths share a hash")
    lines = plain.select("value", F.xxhash64(F.col("_metadata.file_path")).alias("hash"), F.col("_metadata.file_block_start").alias("start"))

    def numbered(run):
        def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def with_numbers():
                for b in batches:
                    files = [by_hash[h] for h in b.column(1).to_pylist()] if len(by_hash) > 1 else [0] * b.num_rows
                    yield pa.RecordBatch.from_arrays([b.column(0), pa.array(files, pa.int64()), b.column(2)], ["value", "file", "start"])
            return run(with_numbers())
        return task

    quoted = lines.filter(F.col("value").contains('"'))
    answers = quoted.mapInArrow(numbered(_answers), "file long, start long, if_closed boolean, if_open boolean")
    # At most one row per range, and none while the ranges begin and end at records.
    changes = sorted((r["file"], r["start"], r["open"]) for r in _changes(answers).collect())
    found = lines.mapInArrow(numbered(_cut(changes)), "place long, text string, begins boolean, ends boolean")
    complete = found.filter("begins AND ends").select("place", "text")
    pieces = found.filter("NOT (begins AND ends)").withColumn("file", F.floor(F.col("place") / FILE_STEP))
    in_file = Window.partitionBy("file").orderBy("place")
    joined = (
        pieces.withColumn("record", F.sum(F.col("begins").cast("int")).over(in_file)).groupBy("file", "record")
        .agg(F.min("place").alias("place"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]), "\n").alias("text"))
        .select("place", "text")
    )
    text = F.regexp_replace("text", "\r(?=\n|\\z)", "")
    return complete.unionByName(joined).select("place", text.alias("text")).filter("text <> ''")


def read(spark: SparkSession, path: str, columns: Sequence[str], options: dict[str, str], row_id: str | None = None) -> DataFrame:
    """The cells of all records as text, without each file's header; ``row_id`` names a column for their place."""
    schema = ", ".join(f"`{c}` STRING" for c in columns)
    cells: Column = F.from_csv("text", F.lit(schema), options)
    rows = records(spark, path).filter(F.col("place") % FILE_STEP != 0).select("place", cells.alias("cells"))
    place = [F.col("place").alias(row_id)] if row_id else []
    return rows.select(*place, *[F.col("cells").getField(c).alias(c) for c in columns])
