"""CSV records whose quoted fields hold line breaks, read in splits.

Spark reads such a file either as a whole (no splits) or line by line (records torn apart).
Here lines are read in splits and put together again.  Whether a line begins inside quotes
depends on the number of quotes before it in its file; the count of a split is a sum, so the
counts of all splits merge in any order, and a running sum over a file's splits (one row a
split) gives the parity at each split's first line.  A task then joins the lines of its split to
records; what is left at the edges, the end of a record that began before and the beginning of
one that ends behind, meets in one small aggregation per torn record.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

LINE_META = ("_path", "_name", "_block")


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """``value, _path, _name, _block``: the lines of text files with their file and split."""
    return (spark.read.option("lineSep", "\n").text(list(paths))
            .select("value", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("_name"),
                    F.col("_metadata.file_block_start").alias("_block")))


def _quotes(col="value") -> F.Column:
    return F.length(col) - F.length(F.replace(F.col(col), F.lit('"'), F.lit("")))


def quote_counts(lines: DataFrame) -> DataFrame:
    """``_path, _block, quotes, odd``: quotes of every split, and lines with an odd number of them.  A
    file without such a line has no line break inside quotes."""
    return (lines.withColumn("q", _quotes()).groupBy("_path", "_block")
            .agg(F.sum("q").alias("quotes"), F.count_if(F.col("q") % 2 == 1).alias("odd")))


def files_with_broken_lines(counts: DataFrame) -> list[str]:
    """Paths (as ``_metadata`` names them) of files with line breaks inside quotes."""
    return [r["_path"] for r in counts.where("odd > 0").select("_path").distinct().collect()]


def records(lines: DataFrame, counts: DataFrame) -> DataFrame:
    """``value, _path, _name, _block, line``: the records of the files, line breaks inside quotes kept.

    ``_block`` is the split in which a record begins and ``line`` its number there.  An unclosed
    quote takes the rest of its file; what follows is one record."""
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    inside = counts.select(F.col("_path").alias("p"), F.col("_block").alias("b"),
                           (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("_inside"))
    # one row a split; a hash join keeps the lines of a split in their order
    rows = lines.join(F.broadcast(inside), (F.col("_path") == F.col("p")) & (F.col("_block") == F.col("b"))).drop("p", "b")

    def assemble(batches):
        run = _Split()
        for b in batches:
            path, name, block = (b.column(i).to_pylist() for i in (1, 2, 3))
            for value, key, inside in zip(b.column(0).to_pylist(), zip(path, name, block), b.column(4).to_pylist()):
                if key != run.key:
                    run.end()
                    run.begin(key, inside)
                run.line(value)
            yield from run.taken()
        run.end()
        yield from run.taken()

    out = rows.select("value", *LINE_META, "_inside").mapInArrow(
        assemble, "value string, _path string, _name string, _block long, line long, edge string")
    out = out.withColumn("edge", F.col("edge"))
    whole = out.where("edge = 'none'").drop("edge")
    # a torn record: the beginning in one split, then whole splits inside it, then its end
    order = Window.partitionBy("_path").orderBy("_block", "line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    torn = (out.where("edge != 'none'").withColumn("record", F.count_if(F.col("edge") == "begins").over(order))
            .groupBy("_path", "record").agg(F.array_sort(F.collect_list(F.struct("_block", "line", "value", "_name"))).alias("parts"))
            .select(F.array_join(F.transform("parts", lambda x: x["value"]), "\n").alias("value"), "_path",
                    F.col("parts")[0]["_name"].alias("_name"), F.col("parts")[0]["_block"].alias("_block"), F.col("parts")[0]["line"].alias("line")))
    return whole.unionByName(torn)


class _Split:
    """The lines of one split, joined to records as they come."""

    def __init__(self):
        self.key, self.rows = None, []
        self.held: list = []

    def begin(self, key, inside: bool) -> None:
        self.key, self.n, self.held = key, 0, []
        self.inside, self.torn = inside, inside         # torn: the record held began in an earlier split

    def line(self, value: str) -> None:
        self.held.append(value)
        self.inside ^= value.count('"') % 2 == 1
        if not self.inside:
            self._put("ends" if self.torn else "none")
            self.torn = False

    def end(self) -> None:
        """The split ends: an open record goes on in the next."""
        if self.key is not None and self.held:
            self._put("goes on" if self.torn else "begins")
        self.key = None

    def _put(self, edge: str) -> None:
        self.rows.append(("\n".join(self.held), *self.key, self.n, edge))
        self.n += 1
        self.held = []

    def taken(self):
        rows, self.rows = self.rows, []
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(cols[i], pa.string()) for i in (0, 1, 2)]
                                             + [pa.array(np.array(cols[i], np.int64)) for i in (3, 4)] + [pa.array(cols[5], pa.string())],
                                             names=["value", "_path", "_name", "_block", "line", "edge"])
