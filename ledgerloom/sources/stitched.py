"""Records of text files whose quoted fields hold line breaks, with each file split among tasks.

Lines are read on their own. Whether a line begins inside a quoted field follows from the lines
before it in the file, so it is the running state over (file, block, line): a line that opens or
closes a field turns it over, and a few malformed ones set it. Only lines that can change the state
are looked at, first within their block of the file, then by one row a block, so nothing but numbers
of such lines is shuffled. The lines between an opening and its closing one are then joined to one
record each; all other lines are records as they are, and are not moved.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import materialised, shared_folder

# A quoted text of more lines than this is taken as a lost quote, and is an error.
MOST_LINES = 100_000


class UnclosedQuote(ValueError):
    """A quoted field without an end."""


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
        F.rtrim("value", F.lit("\r")).alias("line"),
    )


def _quotes(text: str) -> str:
    return f"""(length({text}) - length(replace({text}, '"', '')))"""


def _odd() -> Column:
    """A line that begins inside a quoted field ends outside of it if its quotes are odd."""
    return F.expr(f"{_quotes('line')} % 2 = 1")


def _opens() -> Column:
    """Whether a line that begins outside of quoted fields ends inside one. A quote opens a field
    only at its start; a field goes on over commas until its quotes are even."""
    return F.expr(f"""contains(line, '"') and aggregate(split(line, ',', -1), 0, (inside, part) ->
        if(inside = 0 and not startswith(part, '"'), 0, (inside + {_quotes('part')}) % 2)) = 1""")


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether any line may end inside a quoted field. Few lines have a quote at all, so only those
    are trimmed and looked at."""
    quoted = spark.read.text(path, lineSep="\n").where(F.contains("value", F.lit('"')))
    return not quoted.select(F.rtrim("value", F.lit("\r")).alias("line")).where(_opens()).isEmpty()


def _state(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lines that turn the state over (file, block, id, opens), and per block of a file its
    first and last line, whether it begins inside (`inside`) and ends so (`left_open`)."""
    within = W.partitionBy("file", "block").orderBy("id")
    toggles = F.col("opens") & F.col("odd")
    changes = (
        lines.where("opens or odd")
        .select("file", "block", "id", "opens", "odd")
        .withColumn("turns", F.sum(toggles.cast("int")).over(within))
        # What a line that is not simply opening or closing sets the state to, with the turns so
        # far taken off, so that the turns after it add up on it.
        .withColumn("set", F.when(~toggles, (F.col("opens").cast("int") + F.col("turns")) % 2))
        .withColumn("set", F.last("set", ignorenulls=True).over(within))
    )
    blocks = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.max("id").alias("last"))
    ends = changes.groupBy("file", "block").agg(F.max_by(F.struct("turns", "set"), "id").alias("end"))
    in_file = W.partitionBy("file").orderBy("block")
    carried = F.when(F.col("end.set").isNull(), F.coalesce("end.turns", F.lit(0))).otherwise(0)
    base = F.when(F.col("end.set").isNotNull(), (F.col("end.set") + F.col("end.turns") + F.col("through")) % 2)
    state = (F.coalesce("base", F.lit(0)) + F.col("through")) % 2
    blocks = (
        blocks.join(ends, ["file", "block"], "left")
        .withColumn("through", F.sum(carried).over(in_file))
        .withColumn("base", F.last(base, ignorenulls=True).over(in_file))
        .withColumn("left_open", state == 1)
        .withColumn("inside", F.lag("left_open", 1, False).over(in_file))
        .select("file", "block", "first", "last", "inside", "left_open")
    )
    started = F.coalesce("set", F.col("inside").cast("int"))
    changes = (
        changes.join(blocks.select("file", "block", "inside"), ["file", "block"])
        .withColumn("after", (started + F.col("turns")) % 2)
        .withColumn("before", F.lag("after").over(within))
        .withColumn("before", F.coalesce("before", F.col("inside").cast("int")))
        .where("before <> after")
        .select("file", "block", "id", (F.col("after") == 1).alias("opens"))
    )
    return changes, blocks


def _runs(changes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Stretches of lines of one record within a block: record (the number of its first line),
    block, and the first and last line of the stretch."""
    within = W.partitionBy("file", "block").orderBy("id")
    in_file = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    own = changes.withColumn("next", F.lead("id").over(within)).join(
        blocks.select("file", "block", "last"), ["file", "block"]
    )
    begun = own.where("opens").select(
        F.col("id").alias("record"), "block", F.col("id").alias("from"),
        F.coalesce("next", "last").alias("to"),
    )
    of_block = changes.groupBy("file", "block").agg(
        F.min("id").alias("turn"), F.max(F.when(F.col("opens"), F.col("id"))).alias("opened")
    )
    carried = (
        blocks.join(of_block, ["file", "block"], "left")
        .withColumn("record", F.last("opened", ignorenulls=True).over(in_file))
        .where("inside")
        .select("record", "block", F.col("first").alias("from"), F.coalesce("turn", "last").alias("to"))
    )
    return begun.union(carried)


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record (`record`) of a file or a folder of files, without headers and blank
    lines. Line breaks within quotes stay, as line feeds.

    The lines are written to the shared folder once, with their numbers: what is found of them
    stays true however files are split when they are read again. Files with different headers,
    a quote that does not end and quoted texts of more than MOST_LINES lines are errors.
    """
    app = spark.sparkContext.applicationId
    folder = f"{shared_folder(spark)}/ledgerloom/{app}/lines-{uuid.uuid4().hex}"
    lines = _lines(spark, path).withColumns({"opens": _opens(), "odd": _odd()})
    lines = materialised(lines, f"{folder}/lines")
    changes, blocks = _state(lines)
    changes = materialised(changes, f"{folder}/changes")
    blocks = materialised(blocks, f"{folder}/blocks")
    runs = materialised(_runs(changes, blocks), f"{folder}/runs")

    last_block = blocks.groupBy("file").agg(F.max_by("left_open", "block").alias("left_open"))
    open_file = last_block.where("left_open").first()
    if open_file:
        raise UnclosedQuote(f"{open_file['file']}: a quoted field does not end")
    size = F.sum(F.col("to") - F.col("from") + 1).alias("n")
    long = runs.groupBy("record").agg(size).where(F.col("n") > MOST_LINES).first()
    if long:
        start = lines.where(F.col("id") == long["record"]).first()
        raise UnclosedQuote(f"{start['file']}: quoted text of {long['n']} lines from {start['line']}")

    headers = blocks.where("block = 0").select(F.col("first").alias("id"))
    names = [r["line"] for r in lines.join(headers, "id").select("line").distinct().take(2)]
    if len(names) > 1:
        raise ValueError(f"{path}: files differ in their header: {names}")

    pieces = runs.select("record", "block", F.explode(F.sequence("from", "to")).alias("id"))
    pieces = materialised(pieces, f"{folder}/pieces")
    taken = pieces.select("id").union(headers)
    alone = lines.join(taken, "id", "left_anti").select(F.col("line").alias("record"))
    parts = lines.select("id", "line").join(pieces, "id")
    # As many lines as the record has.
    whole = parts.groupBy("record").agg(
        F.array_sort(F.collect_list(F.struct("block", "id", "line"))).alias("parts")
    )
    joined = whole.select(F.array_join("parts.line", "\n").alias("record"))
    return alone.union(joined).where(F.trim("record") != "")
