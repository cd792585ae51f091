"""CSV records from files read in splits: quoted line breaks without one task per file.

A line either ends inside a quoted cell or outside, depending on how it begins; most lines end one way whatever came
before. What each split does to the state is one small row, running over the splits of a file gives the state each begins
in, and then every task puts its records together on its own. Only a record cut by the end of a split is shuffled.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# What a line does to "inside a quoted cell": nothing, ends outside, ends inside, changes over.
KEEPS, CLOSES, OPENS, FLIPS = range(4)
# A record of more characters than this is no record but an opening quote without its end.
MAX_RECORD = 1024 * 1024
# Records of more cells than this are looked at one by one.
MAX_WIDTH = 500
# Pieces of records at the ends of a split: what a cell from before leaves here, what goes on behind, and both.
WHOLE, HEAD, TAIL, MIDDLE = range(4)


def header_cells(line: str, sep: str) -> list[str]:
    return next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))


def column_names(cells: list[str]) -> list[str]:
    """Names as Spark's reader gives them: empty ones by place, repeated ones with their place behind."""
    times = Counter(c.lower() for c in cells)
    return [f"_c{i}" if not c else f"{c}{i}" if times[c.lower()] > 1 else c for i, c in enumerate(cells)]


def record_pattern(sep: str, width: int) -> str:
    """A record of `width` cells once doubled quotes are gone, alike in Java and Python."""
    s = re.escape(sep)
    cell = f'(?:"[^"]*+"|[^"{s}\\n]*+)'
    return f"{cell}(?:{s}{cell}){{{width - 1}}}"


def line_effects(lines: pa.Array, sep: str) -> np.ndarray:
    """KEEPS, CLOSES, OPENS or FLIPS per line. A quote opens at the start of a cell and closes at its end only; doubled
    quotes and quotes amid a cell are text."""
    effects = np.full(len(lines), KEEPS, np.int32)
    if not len(lines) or lines.buffers()[2] is None:
        return effects
    ends = np.frombuffer(lines.buffers()[1], np.int32)[lines.offset : lines.offset + len(lines) + 1].astype(np.int64)
    data = np.frombuffer(lines.buffers()[2], np.uint8)[: ends[-1]]
    quotes = ends[0] + np.flatnonzero(data[ends[0] :] == ord('"'))
    if not len(quotes):
        return effects
    owner = np.searchsorted(ends, quotes, side="right") - 1
    # Of quotes in a row each two are text, so an odd run is one quote between what stands before and behind the run.
    starts = np.flatnonzero(np.concatenate(([True], (np.diff(quotes) > 1) | (np.diff(owner) > 0))))
    lengths = np.diff(np.append(starts, len(quotes)))
    odd = lengths % 2 == 1
    line, begin = owner[starts[odd]], quotes[starts[odd]]
    end = begin + lengths[odd]
    left, right = begin == ends[line], end == ends[line + 1]
    mark = np.frombuffer(sep.encode(), np.uint8)
    for beside, at, fits in ((left, begin - len(mark), begin - len(mark) >= ends[line]), (right, end, end + len(mark) <= ends[line + 1])):
        beside |= fits & np.all([data[np.where(fits, at + i, 0)] == mark[i] for i in range(len(mark))], axis=0)
    # The last quote that can only open or only close decides; behind it come quotes that can do both.
    last = np.full(len(lines), -1)
    decides = np.flatnonzero(left != right)
    np.maximum.at(last, line[decides], decides)
    both = left & right & (np.arange(len(line)) > last[line])
    flips = np.bincount(line[both], minlength=len(lines)) % 2
    inside = np.append(left, False)[last] ^ (flips == 1)
    return np.where(last >= 0, np.where(inside, OPENS, CLOSES), np.where(flips == 1, FLIPS, KEEPS)).astype(np.int32)


def line_effect(value: Column, sep: str) -> Column:
    """`line_effects` as a column."""

    @F.pandas_udf("int")
    def of(lines: pd.Series) -> pd.Series:
        return pd.Series(line_effects(pa.array(lines, pa.string()), sep))

    return of(value)


class RecordLines:
    """The same rule on single lines, for the few that make no record with those around them."""

    def __init__(self, sep: str, width: int):
        s = re.escape(sep)
        self.sep, self.record = sep, re.compile(record_pattern(sep, width))
        self.quote = re.compile(f'(?<={s})"(?!{s})|(?<!{s})"(?={s})|(?<={s})"(?={s})')

    def ends(self, line: str, inside: bool) -> bool:
        """Whether the line ends inside a quoted cell."""
        padded = f"{self.sep}{line.replace('""', '')}{self.sep}"
        for match in self.quote.finditer(padded):
            opens, closes = padded[match.start() - 1] == self.sep, padded[match.end()] == self.sep
            inside = not inside if opens and closes else opens
        return inside

    def fits(self, text: str) -> bool:
        return len(text) <= MAX_RECORD and self.record.fullmatch(text.replace('""', "")) is not None

    def resolved(self, lines: list[str]) -> list[str]:
        """Records of lines that begin outside a cell. A line whose open cell leads to no record of the header's width has
        a stray quote and stands alone; the lines behind it are read again."""
        found, at = [], 0
        while at < len(lines):
            end, inside, size = at, self.ends(lines[at], False), len(lines[at])
            while inside and end + 1 < len(lines) and size <= MAX_RECORD:
                end += 1
                size += len(lines[end]) + 1
                inside = self.ends(lines[end], True)
            text = "\n".join(lines[at : end + 1])
            if end > at and (inside or not self.fits(text)):
                text, end = lines[at], at
            found.append(text)
            at = end + 1
        return found


def read_lines(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(path, block, split, value) per line; rows keep the order of the file within a task."""
    mark = F.lit("\ufeff")
    text = F.when(F.startswith("value", mark), F.expr("substring(value, 2)")).otherwise(F.col("value"))
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"), text.alias("value")
    )
    return lines.withColumn("split", F.xxhash64("path", "block"))


def within(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in the runs from `first` to `last`, which do not touch."""
    change = np.zeros(n + 1, np.int64)
    change[first] += 1
    change[last + 1] -= 1
    return np.cumsum(change[:-1]) > 0


def whole_records(values: pa.Array, before: np.ndarray, after: np.ndarray, sep: str, width: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Records of several of the given lines, put together at once: their texts, first and last lines. Those that are too
    long or not of the header's width, or are cut by either end of the lines, are not among them."""
    first, last = np.flatnonzero((before == 0) & (after == 1)), np.flatnonzero((before == 1) & (after == 0))
    last = last[np.searchsorted(last, first[0]) :] if len(first) else last[:0]
    first = first[: len(last)]
    if not len(first) or width > MAX_WIDTH:
        return values.slice(0, 0), first[:0], last[:0]
    taken = values.take(pa.array(np.flatnonzero(within(first, last, len(values)))))
    offsets = np.concatenate(([0], np.cumsum(last - first + 1))).astype(np.int32)
    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), taken), "\n")
    # The same pattern; without possessive repeats, as this reader of patterns never goes back.
    pattern = record_pattern(sep, width).replace("*+", "*")
    fits = pc.match_substring_regex(pc.replace_substring(texts, '""', ""), rf"\A(?:{pattern})\z")
    fits = pc.and_(fits, pc.less(pc.utf8_length(texts), MAX_RECORD))
    kept = fits.to_numpy(zero_copy_only=False)
    return texts.filter(fits), first[kept], last[kept]


def split_runs(splits: np.ndarray) -> Iterator[tuple[int, int]]:
    """First place and the one behind the last of every run of equal numbers."""
    cuts = [0, *(np.flatnonzero(np.diff(splits)) + 1).tolist(), len(splits)]
    return ((a, b) for a, b in zip(cuts, cuts[1:]) if a < b)


def split_states(lines: DataFrame, sep: str) -> DataFrame:
    """One row per split: path, block, split, whether any line opens a cell, and the states it begins and ends in.

    A split's lines come one after another in one task, which gives the last that decides the state and the changes behind
    it; the states run over the splits of a file, of which there are few.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: list | None = None
        names = ["path", "block", "split", "opening", "fixed", "change"]
        types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32()]

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(current, types)], names=names)

        for batch in batches:
            splits = batch.column("split").to_numpy()
            effects = line_effects(batch.column("value").cast(pa.string()), sep)
            for a, b in split_runs(splits):
                if current is None or current[2] != int(splits[a]):
                    if current is not None:
                        yield row()
                    current = [batch.column("path")[a].as_py(), batch.column("block")[a].as_py(), int(splits[a]), False, None, 0]
                part = effects[a:b]
                decided = np.flatnonzero((part == CLOSES) | (part == OPENS))
                if len(decided):
                    current[4], current[5] = int(part[decided[-1]] == OPENS), 0
                    part = part[decided[-1] :]
                place = 5 if current[4] is None else 4
                current[place] = (current[place] + int((part == FLIPS).sum())) % 2
                current[3] |= bool((effects[a:b] >= OPENS).any())
        if current is not None:
            yield row()

    schema = "path string, block long, split long, opening boolean, fixed int, change int"
    splits = lines.select("path", "block", "split", "value").mapInArrow(of, schema)
    order = Window.partitionBy("path").orderBy("block")
    splits = splits.withColumn("changes", F.sum("change").over(order))
    based = F.last((F.col("fixed") + F.col("changes")) % 2, ignorenulls=True).over(order)
    splits = splits.withColumn("ends", (F.coalesce(based, F.lit(0)) + F.col("changes")) % 2)
    return splits.select("path", "block", "split", "opening", F.coalesce(F.lag("ends").over(order), F.lit(0)).alias("begins"), "ends")


def states_before(effects: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """The state in front of every line, and behind the last."""
    fixed = (effects == CLOSES) | (effects == OPENS)
    flips = np.cumsum(effects == FLIPS)
    last = np.maximum.accumulate(np.where(fixed, np.arange(len(effects)), -1))
    base = np.where(last < 0, state, effects[last] == OPENS)
    since = flips - np.where(last < 0, 0, flips[last])
    after = (base + since) % 2
    return np.concatenate(([state], after[:-1])), int(after[-1])


def joined_records(lines: DataFrame, inside: set[int], sep: str, width: int, pieces: bool) -> DataFrame:
    """(value, split, piece): whole records or, with `pieces`, what the ends of splits cut. `inside` are the splits that
    begin in a quoted cell; those in which one ends or goes on are bounded by the number of splits."""
    limit = MAX_RECORD

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rule = RecordLines(sep, width)
        current, state, kept, started, size = None, 0, [], False, 0
        # Records of the lines at hand: text, split, piece and the line that ended it.
        out: list[tuple[str, int, int, int]] = []

        def finish(split: int, ended: bool, at: int) -> None:
            nonlocal kept, size
            kind = (WHOLE if ended else TAIL) if started else (HEAD if ended else MIDDLE)
            if kept and (kind == WHOLE or size > limit):
                out.extend((t, split, WHOLE, at) for t in rule.resolved(kept))
            elif kept:
                out.append(("\n".join(kept), split, kind, at))
            kept, size = [], 0

        def made(values: pa.Array, at: np.ndarray, split: int) -> pa.RecordBatch:
            """Texts that are records, at their places, and what is in `out`, in the order of the file."""
            rows = [r for r in out if (r[2] != WHOLE) == pieces]
            out.clear()
            text = pa.concat_arrays([values, pa.array([r[0] for r in rows], pa.string())])
            owner = np.concatenate([np.full(len(at), split, np.int64), np.array([r[1] for r in rows], np.int64)])
            kind = np.concatenate([np.full(len(at), WHOLE, np.int32), np.array([r[2] for r in rows], np.int32)])
            order = np.argsort(np.concatenate([at, np.array([r[3] for r in rows], np.int64)]), kind="stable")
            return pa.RecordBatch.from_arrays(
                [text.take(pa.array(order)), pa.array(owner[order]), pa.array(kind[order])], names=["value", "split", "piece"]
            )

        none = pa.array([], pa.string()), np.array([], np.int64), 0
        for batch in batches:
            splits, values = batch.column("split").to_numpy(), batch.column("value").cast(pa.string())
            effects = line_effects(values, sep)
            for a, b in split_runs(splits):
                split = int(splits[a])
                if split != current:
                    if current is not None:
                        finish(current, False, -1)
                    current, state, started, size = split, int(split in inside), False, 0
                before, state = states_before(effects[a:b], state)
                after = np.append(before[1:], state)
                alone = (before == 0) & (after == 0)
                part = values.slice(a, b - a)
                texts, first, last = whole_records(part, before, after, sep, width)
                for i in np.flatnonzero(~alone & ~within(first, last, b - a)).tolist():
                    line = values[a + i].as_py()
                    if before[i] == 0:
                        kept, started, size = [], True, 0
                    if size > limit:
                        # Too long already: what was kept has no end, its lines go out as they come.
                        out.extend((t, split, WHOLE, i) for t in kept)
                        kept = []
                    kept.append(line)
                    size += len(line) + 1
                    if after[i] == 0:
                        finish(split, True, i)
                        started = False
                at = np.flatnonzero(alone)
                if pieces:
                    yield made(*none[:2], split)
                else:
                    yield made(pa.concat_arrays([part.take(pa.array(at)), texts]), np.concatenate([at, last]), split)
        if current is not None:
            finish(current, False, -1)
        yield made(*none)

    return lines.select("value", "split").mapInArrow(of, "value string, split long, piece int")


def stitched(pieces: DataFrame, splits: DataFrame, sep: str, width: int) -> DataFrame:
    """Records out of the pieces at the ends of splits, in the order of their files. A piece is at most MAX_RECORD long."""
    order = Window.partitionBy("path").orderBy("block", F.when(F.col("piece") == TAIL, 1).otherwise(0))
    placed = pieces.join(splits.select("split", "path", "block"), "split")
    chained = placed.withColumn("record", F.count(F.when(F.col("piece") == TAIL, 1)).over(order))
    parts = F.array_sort(F.collect_list(F.struct("block", "piece", "value")))
    joined = chained.groupBy("path", "record").agg(F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))

    def of(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rule = RecordLines(sep, width)
        for frame in frames:
            yield pd.DataFrame({"value": [record for text in frame["value"] for record in rule.resolved(text.split("\n"))]})

    return joined.select("value").mapInPandas(of, "value string")


def scan_records(spark: SparkSession, path: str, sep: str) -> DataFrame | None:
    """All cells as text, under the names in the first line of the files; None if no line opens a cell that it does not
    close, or if there is a single column, which Spark's own reader takes as well.

    Lines equal to the header are headers, wherever they stand; blank records are left out; a record with fewer cells has
    nulls for the rest. A quoted cell may span lines and splits. Lines that a stray quote would make one record of another
    width are records of their own, so it costs the one it stands in.
    """
    head = spark.read.text(path).where((F.trim("value") != "") & (F.col("_metadata.file_block_start") == 0)).limit(1).collect()
    cells = header_cells(head[0][0], sep) if head else []
    if len(cells) < 2:
        return None
    lines = read_lines(spark, path, sep)
    states = split_states(lines, sep).where("opening OR begins = 1").collect()
    if not states:
        return None
    inside = {r["split"] for r in states if r["begins"]}
    records = joined_records(lines, inside, sep, len(cells), False).select("value")
    cut = [r["split"] for r in states if r["begins"] or r["ends"]]
    if cut:
        at_ends = joined_records(lines.where(F.col("split").isin(cut)), inside, sep, len(cells), True)
        places = [(r["split"], r["path"], r["block"]) for r in states if r["begins"] or r["ends"]]
        splits = spark.createDataFrame(places, "split long, path string, block long")
        records = records.unionByName(stitched(at_ends, splits, sep, len(cells)))
    names = column_names(cells)
    schema = ", ".join(f"c{i} STRING" for i in range(len(names)))
    options = {"sep": sep, "quote": '"', "escape": '"', "multiLine": "true"}
    parsed = records.where(F.trim("value") != "").select(F.from_csv("value", schema, options).alias("row"))
    found = [F.col("row").getField(f"c{i}") for i in range(len(names))]
    is_header = F.lit(True)
    for column, cell in zip(found, cells):
        is_header = is_header & column.eqNullSafe(F.lit(cell or None))
    return parsed.where(~is_header).select(*[column.alias(name) for column, name in zip(found, names)])
