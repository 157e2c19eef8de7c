"""CSV files whose quoted texts hold line breaks, read by many tasks.

A line break ends a record only outside quotes, and whether a block of the file
begins inside quotes is known only from all blocks before it. So every line is
described by what it does to the quote state, whatever the state was: nothing,
swap it, leave it outside, leave it inside. Such effects can be chained: line by
line within a block (for both states the block may begin in), then block by
block, which gives the true state at the start of every block. Records of one
line stay where they are; the lines of the others are put together by the place
of their first line, also across blocks.

Quoting is read as the whole-file reader does: a quote opens a text only at the
start of a cell, a doubled one inside is a character, others mean themselves.
Where the first line ends in CR LF, all of the file's line breaks become LF.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from claimloom.staging import stage

# What a line does to the quote state.
NOTHING, SWAP, OUTSIDE, INSIDE = 0, 1, 2, 3
# Where a reader stands behind some part of a line: at a cell's start, in a bare cell, in quotes, behind a closing quote.
_START, _BARE, _QUOTED, _CLOSED = 0, 1, 2, 3


def line_effect(line: Column, separator: str = ",") -> Column:
    """What ``line`` does to the quote state; the parts between its quotes are read in order."""
    parts = F.split(line, '"', -1)

    def bare(part: Column) -> Column:
        return F.when(part.endswith(separator), F.lit(_START)).otherwise(F.lit(_BARE))

    def behind_quote(place: Column, part: Column) -> Column:
        closed = F.when(part == "", F.lit(_CLOSED)).otherwise(bare(part))
        return F.when(place.isin(_START, _CLOSED), F.lit(_QUOTED)).when(place == _BARE, bare(part)).otherwise(closed)

    def ends_inside(first: Column) -> Column:
        return F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), first, behind_quote) == _QUOTED

    from_outside = ends_inside(F.when(parts[0] == "", F.lit(_START)).otherwise(bare(parts[0])))
    from_inside = ends_inside(F.lit(_QUOTED))
    effect = (
        F.when(~from_outside & from_inside, NOTHING)
        .when(from_outside & ~from_inside, SWAP)
        .when(from_outside, INSIDE)
        .otherwise(OUTSIDE)
    )
    return F.when(F.contains(line, F.lit('"')), effect).otherwise(NOTHING)


def _states(df: DataFrame, group: Sequence[str], order: str, entry: Mapping[str, Column]) -> DataFrame:
    """``df`` with the states ``<name>`` before and ``<name>_after`` each row, for every state that a group begins in.

    Rows are chained by their ``effect`` along ``order``; true is inside quotes.
    """
    along = Window.partitionBy(*group).orderBy(order)
    swaps = F.count_if(F.col("effect") == SWAP)
    upto = swaps.over(along.rowsBetween(Window.unboundedPreceding, 0))
    # a row that forces a state, with the swaps counted up to it
    forced = F.struct((F.col("effect") == INSIDE).alias("inside"), upto.alias("swaps"))
    df = df.withColumn("_forced", F.when(F.col("effect") >= OUTSIDE, forced))
    out = {}
    for suffix, before in (("", True), ("_after", False)):
        frame = along.rowsBetween(Window.unboundedPreceding, -1 if before else 0)
        passed = F.coalesce(swaps.over(frame), F.lit(0))
        last = F.last("_forced", ignorenulls=True).over(frame)
        for name, begin in entry.items():
            since = F.when(last.isNull(), passed).otherwise(passed - last["swaps"])
            out[name + suffix] = F.coalesce(last["inside"], begin) != (since % 2 == 1)
    return df.withColumns(out).drop("_forced")


def read_records(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """(file, block, row, record): every record of the CSV file or folder at ``path``, header lines included.

    ``row`` counts the records that begin in a block from 1; blank lines between
    records do not count. The file is read once, into a staged table of lines.
    """
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        F.col("value"),
    )
    lines = lines.withColumn("effect", line_effect(F.col("value"), separator))
    both = _states(lines, ["file", "block"], "line", {"out": F.lit(False), "in": F.lit(True)})
    along = Window.partitionBy("file", "block").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    blank = F.col("value").isin("", "\r")
    counted = {f"rows_{s}": F.count_if(~F.col(s) & ~blank).over(along) for s in ("out", "in")}
    placed = stage(both.withColumns(counted), "csv-lines")

    last = F.max_by(F.struct("out_after", "in_after", "rows_out", "rows_in"), "line").alias("last")
    returns = F.min_by(F.col("value").endswith("\r"), "line").alias("returns")
    blocks = placed.groupBy("file", "block").agg(last, returns).select("file", "block", "last.*", "returns")
    effect = (
        F.when(F.col("out_after") == F.col("in_after"), F.when(F.col("out_after"), INSIDE).otherwise(OUTSIDE))
        .when(F.col("out_after"), SWAP)
        .otherwise(NOTHING)
    )
    blocks = _states(blocks.withColumn("effect", effect), ["file"], "block", {"inside": F.lit(False)})
    rows = F.when(F.col("inside"), F.col("rows_in")).otherwise(F.col("rows_out"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = F.when(rows > 0, F.struct("block", rows.alias("row")))
    # the record that is still open when a block begins
    open_ = F.last("_begun", ignorenulls=True).over(earlier)
    # lines end as the first line of their file does
    returns = F.first("returns").over(Window.partitionBy("file").orderBy("block"))
    entered = stage(
        blocks.withColumn("_begun", begun).select(
            "file", "block", "inside", open_.alias("open"), returns.alias("returns")
        ),
        "csv-blocks",
    )

    true = {s: F.when(F.col("inside"), F.col("in" + e)).otherwise(F.col("out" + e)) for s, e in (("before", ""), ("after", "_after"))}
    row = F.when(F.col("inside"), F.col("rows_in")).otherwise(F.col("rows_out"))
    known = placed.join(entered, ["file", "block"]).select(
        "file", "block", "line", "value", "open", "returns", row.alias("row"), *[c.alias(s) for s, c in true.items()]
    )
    whole = ~F.col("before") & ~F.col("after")
    single = known.where(whole & ~blank).select("file", "block", "row", "returns", F.col("value").alias("record"))
    here = F.struct("block", "row")
    parts = known.where(~whole).select(
        "file", F.when(F.col("row") > 0, here).otherwise(F.col("open")).alias("at"), F.struct("block", "line", "value").alias("part"), "returns"
    )
    stitched = parts.groupBy("file", "at", "returns").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    records = single.unionByName(
        stitched.select("file", "at.block", "at.row", "returns", F.array_join("parts.value", "\n").alias("record"))
    )
    plain = F.replace(F.regexp_replace("record", "\r\\z", ""), F.lit("\r\n"), F.lit("\n"))
    return records.select("file", "block", "row", F.when(F.col("returns"), plain).otherwise(F.col("record")).alias("record"))


def read_quoted_csv(spark: SparkSession, path: str, names: Sequence[str], separator: str = ",") -> DataFrame:
    """(file, block, row, cells): the rows behind the header, ``cells`` a struct of strings c0, c1, ...

    Cells beyond the named ones are dropped and missing ones are null, as the
    whole-file reader does.
    """
    records = read_records(spark, path, separator)
    body = records.where(~((F.col("block") == 0) & (F.col("row") == 1)))
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"quote": '"', "escape": '"', "sep": separator, "multiLine": "true", "lineSep": "\n"}
    return body.select("file", "block", "row", F.from_csv("record", schema, options).alias("cells"))
