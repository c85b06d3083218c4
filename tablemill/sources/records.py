"""CSV records from files that Spark splits, quoted line breaks included.

Whether a line begins inside a quoted value depends on all lines before it. A first read therefore sums up every
split as a function of that state (two values are all it has); a fold over the splits of each file gives the state
at each split, and a second read joins lines to records. Records that cross the border of two splits come as
fragments, a few per split, and are put together at the end. Files without quoted breaks go to Spark's own reader.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize


@dataclass(frozen=True)
class CsvDialect:
    """What reader, exporter and rejects share: a quote inside a quoted value is doubled, breaks stay as they are."""

    separator: str = ","
    quote: str = '"'
    header: bool = True

    def options(self) -> dict[str, object]:
        blanks = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}  # the writer drops them otherwise
        return {"sep": self.separator, "quote": self.quote, "escape": self.quote, "header": self.header, **blanks}

    def stays_open(self, line: str, inside: bool) -> bool:
        """Whether a quoted value is open after ``line``, given whether one was before it.

        A quote opens a value only as its first character; elsewhere in an unquoted value it is text.
        """
        quote, at = self.quote, 0
        while True:
            if inside:
                while True:
                    end = line.find(quote, at)
                    if end < 0:
                        return True
                    if line[end + 1 : end + 2] != quote:
                        break
                    at = end + 2
                at, inside = end + 1, False
            elif at == 0 and line.startswith(quote):
                at, inside = 1, True
                continue
            at = line.find(self.separator, at)
            if at < 0:
                return False
            at += len(self.separator)
            if line.startswith(quote, at):
                at, inside = at + 1, True


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")


def _by_split(batches: Iterator[pa.RecordBatch]):
    """``path, start, lines`` for the consecutive rows of one split within a batch."""
    for batch in batches:
        paths, starts = batch.column("path"), batch.column("start")
        first = 0
        while first < batch.num_rows:
            path, start = paths[first].as_py(), starts[first].as_py()
            last = first + 1
            if paths[batch.num_rows - 1].as_py() == path and starts[batch.num_rows - 1].as_py() == start:
                last = batch.num_rows
            while last < batch.num_rows and starts[last].as_py() == start and paths[last].as_py() == path:
                last += 1
            yield path, start, batch.column("value").slice(first, last - first)
            first = last


def _split_states(spark: SparkSession, path: str, dialect: CsvDialect) -> DataFrame:
    """Per split the state after it from a closed and from an open start, and whether a value holds a break."""

    def run(batches):
        at, state, breaks = None, [False, True], False

        def rows():
            found = [] if at is None else [(*at, *state, breaks)]
            columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()))]
            return pa.RecordBatch.from_arrays(columns, names=["path", "start", "closed", "opened", "breaks"])

        for file, start, lines in _by_split(batches):
            if (file, start) != at:
                yield rows()
                at, state, breaks = (file, start), [False, True], False
            if pc.any(pc.match_substring_regex(lines, "\r.")).as_py():
                breaks = True
            for line in lines.filter(pc.match_substring(lines, dialect.quote)).to_pylist():
                state = [dialect.stays_open(line, s) for s in state]
                breaks = breaks or state[0]
        yield rows()

    return _lines(spark, path).mapInArrow(run, "path string, start long, closed boolean, opened boolean, breaks boolean")


def _open_splits(states: DataFrame) -> DataFrame:
    """``path, start`` of the splits that begin inside a quoted value; a file's splits are one small group."""

    def fold(table: pa.Table) -> pa.Table:
        table, state, found = table.sort_by("start"), False, []
        for closed, opened in zip(table["closed"].to_pylist(), table["opened"].to_pylist()):
            found.append(state)
            state = opened if state else closed
        return table.select(["path", "start"]).filter(pa.array(found, pa.bool_()))

    return states.groupBy("path").applyInArrow(fold, "path string, start long")


def csv_records(spark: SparkSession, path: str, dialect: CsvDialect = CsvDialect()) -> DataFrame | None:
    """``path, record`` of every data record as it stands in the file, or None if every record is one line.

    A header line is left out of each file, blank lines and a carriage return at the end of a record, too. Jobs run
    at once: the states of the splits are stored in the shared folder, and the splits that begin inside a value
    (fewer than the splits that the scheduler keeps anyway) are named to the tasks.
    """
    states = materialize(_split_states(spark, path, dialect), "csv-splits")
    # Without one no split of a file is left open, so that every split begins between two records.
    if states.where("breaks OR closed").isEmpty():
        return None
    opened = {(r["path"], r["start"]) for r in _open_splits(states).toLocalIterator()}

    def run(batches):
        at, held, inside, head, first = None, [], False, False, False
        out: list[tuple] = []

        def end(kind: str) -> None:
            nonlocal held, head
            text = "\n".join(held)
            out.append((*at, kind, text, first and kind == "record"))
            held, head = [], False

        def flush():
            nonlocal out
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.bool_())
            batch = pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["path", "start", "kind", "record", "first"])
            out = []
            return batch

        for file, start, lines in _by_split(batches):
            if (file, start) != at:
                if held:
                    end("through" if head else "tail")
                at, inside, first = (file, start), (file, start) in opened, start == 0
                head = inside
            for line, quoted in zip(lines.to_pylist(), pc.match_substring(lines, dialect.quote).to_pylist()):
                held.append(line)
                if quoted:
                    inside = dialect.stays_open(line, inside)
                if not inside:
                    end("head" if head else "record")
                    first = False
            yield flush()
        if held:
            end("through" if head else "tail")
        yield flush()

    pieces = _lines(spark, path).mapInArrow(run, "path string, start long, kind string, record string, first boolean")

    def join(table: pa.Table) -> pa.Table:
        table, records, parts = table.sort_by("start"), [], []
        order = {"head": 0, "through": 0, "tail": 1}
        rows = sorted(zip(table["start"].to_pylist(), [order[k] for k in table["kind"].to_pylist()], table["kind"].to_pylist(), table["record"].to_pylist()))
        for _, _, kind, text in rows:
            parts.append(text)
            if kind == "head":
                records.append("\n".join(parts))
                parts = []
        if parts:
            records.append("\n".join(parts))  # the file ends inside a value
        first = table["path"][0].as_py()
        return pa.table({"path": pa.array([first] * len(records), pa.string()), "record": pa.array(records, pa.string())})

    whole = pieces.where("kind = 'record'" + (" AND NOT first" if dialect.header else "")).select("path", "record")
    crossing = pieces.where("kind <> 'record'").groupBy("path").applyInArrow(join, "path string, record string")
    records = whole.unionByName(crossing).withColumn("record", F.regexp_replace("record", r"\r\z", ""))
    return records.where(F.length(F.trim("record")) > 0)
