"""Line dedup: repeated runs of lines are deleted but for their first copy, by a suffix array.

A line is named by 128 bits of hash; the names that occur twice or more are sorted once, and
from there on a line is its place in that order. A document becomes stretches of repeated
lines (a line that occurs once ends a run), and stretches of fewer than ``min_words`` words
leave. Prefix doubling sorts the suffixes of all stretches: the pair (rank of this suffix,
rank of the one ``h`` lines on) is ranked again by a range sort of the distinct pairs, with
``h`` = 1, 2, 4, .. until the longest least run is covered or no group of equal suffixes
splits any more. A suffix's least run reaches from its first line to the one at which it has
``min_words`` words; only that much of the longest common prefix with the suffix before it in
the array decides. Where it is shorter than the least run, an interval begins. The interval's
first suffix, by (doc_id, line), is kept, the run is deleted from the others. Blank lines
between deleted lines go with them.

The same is done from the last line backwards. Together the least runs cover every maximal
repeated run of ``min_words`` words exactly: all starts from which enough words follow inside
it cover all but its end, and the one that ends with it covers the rest. The first copy of a
line in the corpus is never deleted. ``min_words`` may be 1: then a line that recurs is a run.

All of it is DataFrame expressions. A rank is an id given in the order of a range sort, so it
is unique and ordered without one task ever counting all of them. The array is cut into ranges
that no frequent suffix can fill alone (ties go by document and line); a range's first suffix
meets the last one before it, and its first interval goes on from there, by tables of a row per
range. Joins leave hot names to adaptive splitting, for which both sides are written first;
groups are reduced by partial aggregation, windows run over the lines of one document or over
one range.

Null texts are empty. A null id comes first in the order. Rows that agree in id
and text are one document and get the same result. Blank lines are kept and
break no run. Texts of any length are read whole; an empty table gives an
empty result; extra columns do not matter.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

MIN_WORDS = 50
WHITE = " \t\r\x0B\f"


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(WHITE))


def _texts_of(key: str, text: str) -> list[Column]:
    return [F.col(f"`{key}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")]


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    return docs.select(*_texts_of(key, text)).withColumn("version", F.xxhash64("text"))


def _lines(rows: DataFrame) -> DataFrame:
    """(doc_id, version, at, pos, name, check, words) of the non-blank lines; ``at`` numbers them, ``pos`` all lines."""
    every = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("pos"), _trimmed(x).alias("line")))
    some = F.filter(every, lambda x: x["line"] != "")
    return rows.select("doc_id", "version", F.posexplode(some).alias("at", "x")).select(
        "doc_id",
        "version",
        "at",
        "x.pos",
        F.xxhash64("x.line").alias("name"),
        F.xxhash64(F.lit("check"), "x.line").alias("check"),
        F.regexp_count("x.line", F.lit("[^ \t\r\x0B\f]+")).cast("long").alias("words"),
    )


DOC = ("doc_id", "version")
RANGE_BITS = 33  # an id holds the number of its range above as many bits of its place there


def _in_order(rows: DataFrame, purpose: str, name: str, *order: str) -> DataFrame:
    """The rows, written, with an id that grows with ``order``, by which no two rows may agree."""
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return common.stored(rows.withColumn(name, F.monotonically_increasing_id()), purpose)


def _stretches(lines: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, version, stretch, at, pos, words, rank): the repeated lines, in stretches of enough words."""
    often = lines.groupBy("name", "check").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    often = _in_order(often, "repeated-lines", "rank", "name", "check")
    lines = lines.join(often, ["name", "check"]).drop("name", "check")
    order = Window.partitionBy(*DOC).orderBy("at")
    before = F.lag("at").over(order)  # a repeated row gives its lines twice
    lines = lines.withColumn("before", before).where("before IS NULL OR before <> at").drop("before")
    lines = lines.withColumn("stretch", F.col("at") - F.row_number().over(order))
    enough = F.sum("words").over(Window.partitionBy(*DOC, "stretch"))
    return common.stored(lines.withColumn("enough", enough).where(F.col("enough") >= min_words).drop("enough"), "line-stretches")


def _least_runs(lines: DataFrame, min_words: int, ahead: bool) -> DataFrame:
    """The shortest run of ``min_words`` words from each line on, or back: where it lies and its lines' ranks.

    ``run`` is null where the stretch has not that many words left. ``step`` numbers the lines in the direction.
    """
    lines = lines.withColumn("step", F.col("at") if ahead else -F.col("at"))
    stretch = Window.partitionBy(*DOC, "stretch")
    lines = lines.withColumn("start_words", F.sum("words").over(stretch.orderBy("step")) - F.col("words"))
    frame = stretch.orderBy("start_words").rangeBetween(0, min_words - 1)
    found = lines.select(
        *DOC,
        "stretch",
        "step",
        "rank",
        "at",
        "pos",
        F.last("at").over(frame).alias("far_at"),
        F.last("pos").over(frame).alias("far_pos"),
        F.when(F.sum("words").over(frame) >= min_words, F.collect_list("rank").over(frame)).alias("run"),
    )
    near, far = ("", "far_") if ahead else ("far_", "")
    return found.select(
        *DOC,
        "stretch",
        "step",
        "rank",
        F.col(f"{near}pos").alias("begin"),
        F.col(f"{far}pos").alias("end"),
        F.col(f"{near}at").alias("first"),
        F.col(f"{far}at").alias("last"),
        "run",
    )


def suffix_ranks(suffixes: DataFrame, depth: int) -> DataFrame:
    """(doc_id, version, stretch, step, rank): ranks of the suffixes by their first ``depth`` lines or more.

    ``rank`` comes in as that of the line. Suffixes have equal ranks where these lines are equal, the end of
    a stretch included, which comes before every line.
    """
    rows, h, groups = suffixes.select(*DOC, "stretch", "step", "rank"), 1, None
    while h < depth:
        order = Window.partitionBy(*DOC, "stretch").orderBy("step")
        pairs = rows.withColumn("next", F.coalesce(F.lead("rank", h).over(order), F.lit(-1)))
        pairs = common.stored(pairs, "suffix-pairs")
        ranks = _in_order(pairs.select("rank", "next").distinct(), "suffix-ranks", "pair", "rank", "next")
        rows = pairs.join(ranks, ["rank", "next"]).select(*DOC, "stretch", "step", F.col("pair").alias("rank"))
        before, groups = groups, ranks.count()
        h *= 2
        if groups == before:  # no group has split, so none ever will
            break
    return common.stored(rows, "suffix-ranks")


def suffix_array(suffixes: DataFrame, ranks: DataFrame) -> DataFrame:
    """The suffixes that have a least run, in order: ``place`` grows along the array.

    ``common`` is how many lines of the least run are shared with the suffix before it; ``interval`` is the place
    of the last suffix, up to this one, that does not share its whole least run: suffixes of one interval do.
    """
    key = [*DOC, "stretch", "step"]
    same = reduce(and_, [F.col(f"s.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key])
    rows = suffixes.where("run IS NOT NULL").drop("rank").alias("s").join(ranks.alias("r"), same).select("s.*", "r.rank")
    rows = _in_order(rows, "suffix-array", "place", "rank", *DOC, "step")
    rows = rows.withColumn("range", F.shiftright("place", RANGE_BITS))
    inside = Window.partitionBy("range").orderBy("place")
    ranges = Window.orderBy("range")  # of a row for each range of the array
    lasts = rows.groupBy("range").agg(F.max_by("run", "place").alias("ended"))
    lasts = common.stored(lasts.withColumn("ended", F.lag("ended").over(ranges)), "suffix-seams")
    rows = rows.join(F.broadcast(lasts), "range")  # as many rows as ranges
    before = F.coalesce(F.lag("run").over(inside), "ended")
    differ = F.array_position(F.zip_with("run", before, lambda a, b: a.eqNullSafe(b)), F.lit(False))
    shared = F.when(before.isNull(), 0).when(differ == 0, F.size("run")).otherwise(differ - 1)
    rows = rows.withColumn("common", shared.cast("int")).drop("ended")
    begins = F.when(F.col("common") < F.size("run"), F.col("place"))
    rows = common.stored(rows.withColumn("head", F.max(begins).over(inside)).drop("run", "rank"), "suffix-heads")
    heads = rows.groupBy("range").agg(F.max("head").alias("head"))
    carried = F.max("head").over(ranges.rowsBetween(Window.unboundedPreceding, -1))
    heads = common.stored(heads.select("range", carried.alias("carried")), "suffix-carried")
    rows = rows.join(F.broadcast(heads), "range")
    return rows.withColumn("interval", F.coalesce("head", "carried")).drop("head", "carried", "range")


def removed_runs(docs: DataFrame, min_words: int = MIN_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, version, begin, end): the runs to delete, by line number from 0, merged where they meet."""
    if min_words < 1:
        raise ValueError("a run has a word at least")
    lines = _stretches(_lines(_texts(docs, key, text)), min_words)
    sides = []
    for ahead in (True, False):
        suffixes = common.stored(_least_runs(lines, min_words, ahead), "line-suffixes")
        depth = suffixes.agg(F.max(F.size("run"))).first()[0] or 0
        array = suffix_array(suffixes, suffix_ranks(suffixes, depth))
        sides.append(array.withColumn("ahead", F.lit(ahead)))
    runs = sides[0].unionByName(sides[1])
    runs = runs.select(*DOC, "begin", "end", "first", "last", "ahead", "interval", F.struct(*DOC, "begin").alias("where"))
    runs = common.stored(runs, "line-runs")
    # An interval of the suffix array: its first suffix stays.
    kept = runs.groupBy("ahead", "interval").agg(F.min("where").alias("kept"), F.max("where").alias("other"))
    kept = kept.where(~F.col("kept").eqNullSafe(F.col("other"))).drop("other")
    kept = common.stored(kept, "kept-runs")
    later = runs.join(kept, ["ahead", "interval"]).where(~F.col("where").eqNullSafe(F.col("kept")))
    later = later.select(*DOC, "begin", "end", "first", "last").distinct()
    order = Window.partitionBy(*DOC).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reached.isNull() | (F.col("first") > reached + 1), 1).otherwise(0)
    later = later.withColumn("fresh", fresh).withColumn("part", F.sum("fresh").over(order))
    return later.groupBy(*DOC, "part").agg(F.min("begin").alias("begin"), F.max("end").alias("end")).drop("part")


def dedup_lines(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    key: str = "doc_id",
    text: str = "text",
    counts: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """All columns of ``docs``, the texts without later copies, and the numbers of lines and of lines removed.

    ``counts`` names the two numbers; columns of ``docs`` with these names are replaced.
    """
    gone = (
        removed_runs(docs, min_words, key, text)
        .groupBy("doc_id", "version")
        .agg(F.collect_list(F.struct("begin", "end")).alias("gone"))
    )
    rows = docs.drop(*counts).select(F.struct("*").alias("row"), *_texts_of(key, text))
    rows = rows.withColumn("version", F.xxhash64("text")).alias("r")
    same = F.col("r.doc_id").eqNullSafe(F.col("g.doc_id")) & (F.col("r.version") == F.col("g.version"))
    joined = rows.join(gone.alias("g"), same, "left").select("row", "r.text", "gone")
    lines = F.split("text", "\n")
    left = F.filter(lines, lambda x, i: ~F.exists("gone", lambda g: i.between(g["begin"], g["end"])))
    joined = joined.withColumn("left", F.when(F.col("gone").isNotNull(), left))
    whole = F.when(F.col("gone").isNull(), F.col(f"row.`{text}`")).otherwise(F.array_join("left", "\n"))
    n = F.size(lines)
    return joined.select(
        *[(whole if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns if c not in counts],
        n.cast("long").alias(counts[0]),
        F.when(F.col("gone").isNull(), 0).otherwise(n - F.size("left")).cast("long").alias(counts[1]),
    )
