"""Landed stream offsets as interval sets: what was landed twice, what is missing, and reading each offset once.

A stream partition may hold a third of all offsets. Every step therefore works on blocks of offsets: what lies within a block
is found there, and what reaches over the border of a block is put together from two rows per block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STREAM = ["topic", "partition"]
# Offsets of a block in which intervals are found, and rows of a block in which rows are compared with intervals.
BLOCK, ROW_BLOCK = 1 << 20, 1 << 10


def _block(at: str, size: int) -> Column:
    return F.expr(f"(`{at}` - pmod(`{at}`, {size}L)) div {size}L")


def _joined(pieces: DataFrame, keys: Sequence[str], size: int) -> DataFrame:
    """Intervals (keys, first, last) within blocks to whole ones. Only those at the border of a block can go on in
    another, so only these meet in a window over all blocks: two rows per block at most."""
    at_border = (F.pmod("first", F.lit(size)) == 0) | (F.pmod(F.col("last") + 1, F.lit(size)) == 0)
    columns = [*keys, "first", "last"]
    marked = pieces.select(*columns, at_border.alias("_border"))
    along = Window.partitionBy(*keys).orderBy("first")
    starts = F.coalesce(F.lag("last").over(along) + 1 < F.col("first"), F.lit(True))
    chained = marked.where("_border").withColumn("_starts", starts.cast("long")).withColumn("_chain", F.sum("_starts").over(along))
    whole = chained.groupBy(*keys, "_chain").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return marked.where("not _border").select(*columns).unionByName(whole.select(*columns))


def intervals(rows: DataFrame, by: Sequence[str] = (), at: str = "offset", stream: Sequence[str] = STREAM, size: int = BLOCK) -> DataFrame:
    """Runs of consecutive offsets (gaps and islands): stream columns, ``by`` columns, first, last.

    An offset that occurs several times counts once; rows without one are left out. Nulls in the stream columns are a stream of their own.
    """
    keys = [*stream, *by]
    block = [*keys, "_block"]
    placed = rows.where(F.col(at).isNotNull()).select(*keys, F.col(at).cast("long").alias("_at"), _block(at, size).alias("_block"))
    # the rank grows with the offset along a run of consecutive ones, and repeated offsets share it
    ranked = placed.withColumn("_island", F.col("_at") - F.dense_rank().over(Window.partitionBy(*block).orderBy("_at")))
    pieces = ranked.groupBy(*block, "_island").agg(F.min("_at").alias("first"), F.max("_at").alias("last"))
    return _joined(pieces, keys, size)


def holes(landed: DataFrame, size: int = BLOCK) -> DataFrame:
    """(topic, partition, first, last) of offsets between the first and last landed one of a stream that no run has.

    ``landed`` holds intervals of any runs. Compacted and transactional topics have holes of their own.
    """
    covered = _covered(landed, size)
    block = [*STREAM, "_block"]
    inside = Window.partitionBy(*block).orderBy("first")
    within = covered.withColumn("_next", F.lead("first").over(inside))
    # a row per block
    ends = covered.groupBy(*block).agg(F.min("first").alias("_low"), F.max("last").alias("last"))
    across = ends.withColumn("_next", F.lead("_low").over(Window.partitionBy(*STREAM).orderBy("_block")))
    both = within.select(*STREAM, "last", "_next").unionByName(across.select(*STREAM, "last", "_next"))
    return both.where("_next > last + 1").select(*STREAM, (F.col("last") + 1).alias("first"), (F.col("_next") - 1).alias("last"))


def _cut(landed: DataFrame, size: int) -> DataFrame:
    """Intervals cut at the borders of blocks."""
    cut = landed.withColumn("_block", F.explode(F.sequence(_block("first", size), _block("last", size))))
    return cut.withColumns(
        {
            "first": F.greatest("first", F.col("_block") * size),
            "last": F.least("last", F.col("_block") * size + (size - 1)),
        }
    )


def _depths(landed: DataFrame, size: int) -> DataFrame:
    """(topic, partition, _block, first, last, depth): stretches of each block with how many intervals cover them."""
    cut = _cut(landed, size)
    edges = F.inline(F.array(F.struct(F.col("first").alias("_at"), F.lit(1).alias("_step")), F.struct((F.col("last") + 1).alias("_at"), F.lit(-1).alias("_step"))))
    steps = cut.select(*STREAM, "_block", edges).groupBy(*STREAM, "_block", "_at").agg(F.sum("_step").alias("_step"))
    along = Window.partitionBy(*STREAM, "_block").orderBy("_at")
    deep = steps.withColumn("depth", F.sum("_step").over(along)).withColumn("_next", F.lead("_at").over(along))
    return deep.where("depth > 0").select(*STREAM, "_block", F.col("_at").alias("first"), (F.col("_next") - 1).alias("last"), "depth")


def _covered(landed: DataFrame, size: int) -> DataFrame:
    """What any interval covers, in stretches within blocks that may touch each other."""
    return _depths(landed, size).select(*STREAM, "_block", "first", "last")


def duplicates(landed: DataFrame, size: int = BLOCK) -> DataFrame:
    """(topic, partition, first, last, times): stretches of offsets that several of the given intervals hold.

    With intervals by run, ``times`` is the number of runs that landed them.
    """
    often = _depths(landed, size).where("depth > 1")
    pieces = often.select(*STREAM, F.col("depth").alias("times"), "first", "last")
    # stretches of the same depth that touch within a block don't occur, since each has its edge where the depth changes
    return _joined(pieces, [*STREAM, "times"], size).select(*STREAM, "first", "last", "times")


def in_intervals(rows: DataFrame, found: DataFrame, at: str, keys: Sequence[str], how: str, size: int = ROW_BLOCK) -> DataFrame:
    """Semi or anti join of rows with intervals: those whose value ``at`` lies in one of them, or in none.

    Intervals are cut into blocks and joined by block and range, which Spark does without moving the rows as long
    as the intervals are few, and spread over all blocks otherwise.
    """
    cut = _cut(found.select(*keys, "first", "last"), size)
    named = {c: f"_r_{c}" for c in (*keys, "first", "last", "_block")}
    right = cut.select(*[F.col(c).alias(n) for c, n in named.items()])
    inside = _block(at, size) == F.col("_r__block")
    for c in keys:
        inside &= rows[c].eqNullSafe(F.col(f"_r_{c}"))
    inside &= F.col(at).between(F.col("_r_first"), F.col("_r_last"))
    return rows.join(right, inside, f"left_{how}")


def repeated_rows(rows: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """(src_path, first, last): the rows of files that hold an offset which an earlier row holds, as row intervals.

    ``rows``: topic, partition, offset, src_path, src_row and what ``order`` names, which tells the earlier one of two
    deliveries; ties go by file and row. Only these narrow columns are read and moved, by single offsets.
    """
    narrow = rows.where(F.col("offset").isNotNull())
    along = Window.partitionBy(*STREAM, "offset").orderBy(*order, "src_path", "src_row")
    later = narrow.select(*STREAM, "offset", "src_path", "src_row", F.row_number().over(along).alias("_nth")).where("_nth > 1")
    return intervals(later, at="src_row", stream=["src_path"])


def each_once(rows: DataFrame, order: Sequence[str | Column] = ("ingest_ts", "run_id")) -> DataFrame:
    """Rows of bronze files with each (topic, partition, offset) once: its first delivery. Rows without an offset stay.

    The repeated rows are found from narrow columns and left out by an anti join over row ranges of their files, so
    the texts are not moved.
    """
    return in_intervals(rows, repeated_rows(rows, order), "src_row", ["src_path"], "anti")
