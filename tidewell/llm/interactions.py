"""How document filters interact: what each removes in every order that they may be applied in.

Documents are counted by mask first, one bit for each filter that a document fails, so all that follows grows with the
number of masks and not with the documents. Each mask cell folds across the array of all orders (a constant of the
plan): one struct of counts for every order and step, weighted by the cell's documents. The arrays of a part's cells,
2 ** filters at most, are merged by elementwise sums.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: What a step counts; unique_fails belongs to the step's filter whatever the order.
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_STRUCT = ", ".join(f"{c}: bigint" for c in COUNTS)


def text_filters(text: Column) -> dict[str, Column]:
    """The filters on a document's own text by letter; a condition that holds means that the document fails. A null text counts as the empty one."""
    text = F.coalesce(text, F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    return {
        "A": F.size(words) < 100,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 80,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.char_length(text) * 10,
        "D": text.rlike("[#$%&*|]"),
    }


def orders(letters: str) -> list[str]:
    """All orders of the filters, in the order of their letters."""
    return ["".join(p) for p in permutations(letters)]


def document_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents by language and by the letters of the filters that they fail, A to D of text_filters() and E for a text that a smaller doc_id has as well, anywhere in the table.

    Texts are compared by their SHA-256. Equal texts fail A to D alike, so rows are first counted by text, part and
    id, then by text and part with the rows of the least id beside; a text that a third of all rows share shrinks in
    the map-side combine, and no join carries texts. Null texts are empty, null languages the empty part. Rows of one
    id and text are equal: none has a smaller id; a null id is smaller than none and has none smaller. A document is
    good or toxic if any row of `labels` of its id says so; null ids have no labels. Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang"), F.lit("")).alias("part"), F.sha2(text, 256).alias("digest"), *(c.alias(x) for x, c in text_filters(F.col("text")).items()))
    rows = rows.withColumn("own", F.concat(*(F.when(F.col(x), x).otherwise("") for x in "ABCD"))).drop(*"ABCD")
    rows = rows.groupBy("doc_id", "part", "digest", "own").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.when(F.col("quality") == 1, 1)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1)).alias("toxic"))
    # Null ids find no label; their digests spread them over the join's partitions.
    salt = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0)
    marked = rows.withColumn("_salt", salt).join(marks.withColumn("_none", F.lit(0).cast("long")), (F.col("doc_id") == F.col("_id")) & (F.col("_salt") == F.col("_none")), "left")
    one = marked.select("doc_id", "part", "digest", "own", "n", *(F.when(F.col(c) == 1, F.col("n")).otherwise(0).alias(c) for c in ("good", "toxic")))
    counts = ("n", "good", "toxic")
    least = F.min_by(F.struct(*counts), "doc_id")
    texts = one.groupBy("digest", "part", "own").agg(*(F.sum(c).alias(c) for c in counts), F.min("doc_id").alias("first_id"), least.alias("first"), *(F.sum(F.when(F.col("doc_id").isNull(), F.col(c)).otherwise(0)).alias(f"{c}_null") for c in counts))
    # One row for each part of a text: a language or so.
    mine = F.col("first_id") == F.min("first_id").over(Window.partitionBy("digest"))
    free = lambda c: F.col(f"{c}_null") + F.when(mine, F.col(f"first.{c}")).otherwise(0)
    split = texts.select("part", "own", *counts, *(free(c).alias(f"{c}_free") for c in counts))
    cells = split.select("part", F.explode(F.array(
        F.struct(F.col("own").alias("mask"), *(F.col(f"{c}_free").alias(c) for c in counts)),
        F.struct(F.concat("own", F.lit("E")).alias("mask"), *((F.col(c) - F.col(f"{c}_free")).alias(c) for c in counts)))).alias("c")).select("part", "c.*")
    return cells.where("n > 0").groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in counts))


def folded(cells: DataFrame, letters: str) -> DataFrame:
    """Each cell with `steps`: a struct of COUNTS for each order and step, orders in a row."""
    every = F.array(*map(F.lit, orders(letters)))

    def step(order: Column):  # noqa: ANN202
        def fold(state: Column, at: Column) -> Column:
            letter = F.substring(order, at, F.lit(1))
            fails = F.contains("mask", letter)
            gone = state["gone"]
            now = ~gone & fails
            count = lambda when, n="n": F.when(when, F.col(n)).otherwise(0)
            here = F.struct(
                count(~gone & ~fails).alias("kept"), count(now).alias("removed"), count(gone & fails).alias("redundant"),
                count(F.col("mask") == letter).alias("unique_fails"), count(now, "good").alias("good_lost"), count(now, "toxic").alias("toxic_lost"))
            return F.struct((gone | fails).alias("gone"), F.concat(state["steps"], F.array(here)).alias("steps"))

        return fold

    start = F.struct(F.lit(False).alias("gone"), F.array().cast(f"array<struct<{_STRUCT}>>").alias("steps"))
    steps = F.transform(every, lambda order: F.aggregate(F.sequence(F.lit(1), F.lit(len(letters))), start, step(order), lambda s: s["steps"]))
    return cells.withColumn("steps", F.flatten(steps))


def interactions(cells: DataFrame, letters: str) -> DataFrame:
    """One row for each part, order and step: (part, filter_order, step, COUNTS, shapley).

    cells: (part, mask, n, good, toxic), one row a part and mask; the mask holds the letters of the failed filters.
    shapley is what the step's filter removes, summed over all orders and whatever step it has in each. A part
    without documents has no rows, so an empty table gives none.
    """
    size = len(letters) * math.factorial(len(letters))
    zero = F.array_repeat(F.struct(*(F.lit(0).cast("long").alias(c) for c in COUNTS)), size)
    add = lambda a, b: F.struct(*((a[c] + b[c]).alias(c) for c in COUNTS))
    merged = folded(cells, letters).groupBy("part").agg(F.aggregate(F.collect_list("steps"), zero, lambda a, b: F.zip_with(a, b, add)).alias("steps"))
    names = F.array(*map(F.lit, orders(letters)))
    rows = merged.select("part", F.posexplode("steps").alias("at", "c"))
    rows = rows.select("part", F.element_at(names, F.floor(F.col("at") / len(letters)).cast("int") + 1).alias("filter_order"), (F.pmod("at", F.lit(len(letters))) + 1).cast("int").alias("step"), "c.*")
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    # A part's rows are one for each order and step.
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", letter)))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """interactions() of the five filters of document_cells()."""
    return interactions(document_cells(docs, labels), "ABCDE")

