"""How far the sources of a language diverge in their words, and by which terms.

Terms are counted inside each Arrow batch, so the shuffle carries a batch's vocabulary and not its words. From then on
work goes by count cells: the terms of a group that have the same count there and the same count on the other side
have the same probabilities, so the divergence is computed once a cell and weighted by the number of its terms. The
best cells of a group are ranked with their cumulative multiplicity, and only those that can hold one of the first
ranks are expanded into terms.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewell.llm.scratch import Scratch, slices

#: A term belongs to its language's vocabulary if so many of its documents have it; part `term` goes to this rank.
LEAST_DOCS, RANKS = 10, 10
#: Probabilities are whole numbers of this fraction, and every term counts for PRIOR more than it occurs.
SCALE, PRIOR = 1_000_000_000, 2
#: Different terms, and documents, that a task holds before it hands their counts on.
HELD = 500_000
#: Bytes of a text that are cut into terms at once.
WINDOW = 1 << 20

#: More than a term can occur in what a task holds at once: that would take 2 TB of text.
_DOC = 1 << 41
#: ASCII letters in lower case and all bytes of other characters as they are, everything else a blank.
_FOLD = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text (runs of ASCII letters and other characters beyond ASCII, A-Z in lower case), in lists of bounded size."""
    folded = text.encode().translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + WINDOW)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # By group and term: occurrences, and _DOC for each document.
    held: dict[tuple[str, str], dict[bytes, int]] = {}
    rows = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), found in held.items():
            both = np.fromiter(found.values(), np.int64, len(found))
            name = lambda x, n=len(found): pa.array([x] * n, pa.string())
            yield pa.RecordBatch.from_arrays([name(lang), name(source), pa.array(found.keys(), pa.binary()).cast(pa.string()), pa.array(both % _DOC), pa.array(both // _DOC)], ["lang", "source", "term", "n", "docs"])
        held.clear()

    for batch in slices(batches):
        for lang, source, text in zip(*(batch[c].to_pylist() for c in ("lang", "source", "text")), strict=True):
            own: Counter = Counter()
            for some in terms(text):
                own.update(some)
            found = held.setdefault((lang, source), {})
            before = found.get
            for term, n in own.items():
                found[term] = before(term, 0) + n + _DOC
        rows += batch.num_rows
        if rows >= HELD or sum(map(len, held.values())) >= HELD:
            yield from flush()
            rows = 0
    yield from flush()


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of each term and documents that hold it, by group; null texts, languages and sources count as ''.

    Tasks hand on a term once for each source (and HELD), so even the commonest term is a few rows a task; the rows are
    dealt by language and term, which the sums by term after it need as well.
    """
    blank = [F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    found = docs.select(*blank).mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    return found.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def probability(n: Column, total: Column, vocabulary: Column) -> Column:
    """1 + floor(SCALE * (n + PRIOR) / (total + PRIOR * vocabulary)), exact beyond the range of long; null without a vocabulary."""
    whole = lambda c: c.cast("decimal(19,0)")
    bottom = whole(total) + F.lit(PRIOR) * whole(vocabulary)
    return F.when(vocabulary > 0, F.lit(1) + F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * (whole(n) + PRIOR), bottom))


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); within the range of long as p and q are SCALE + 1 at most."""
    return F.call_function("div", (p - q) * (p - q), p + q)


class Audit:
    """Counts of a table of documents that both parts go on from: the kept terms by language (written once), groups and languages."""

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        scratch = Scratch(docs.sparkSession, "divergence")
        counted = term_counts(docs)
        kept = counted.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("counts")).where(F.col("docs") >= least_docs)
        #: (lang, term, total, counts): counts has one entry for each source of the language with the term.
        self.kept = scratch.save(kept.select("lang", "term", "total", "counts"), "kept")
        #: (lang, source, term, n, total)
        self.rows = self.kept.select("lang", "term", "total", F.explode("counts").alias("c")).select("lang", "c.source", "term", "c.n", "total")
        #: (lang, source, n, total, m): how many terms of a group have these counts there and in its language.
        self.cells = scratch.save(self.rows.groupBy("lang", "source", "n", "total").agg(F.count("*").alias("m")), "cells")
        langs = self.kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("lang_n"))
        sums = self.cells.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("m")).alias("group_n"))
        groups = docs.select(*(F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
        #: (lang, source, group_n, lang_n, v), also of groups without terms.
        self.groups = scratch.save(groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left").na.fill(0, ["group_n", "lang_n", "v"]), "groups")

    def top_terms(self, ranks: int = RANKS) -> DataFrame:
        """(lang, source, item, value, rank): the terms that a group has more of than its language, by divergence, ties in UTF-8 order."""
        cells = self.cells.join(self.groups, ["lang", "source"])
        p, q = probability(F.col("n"), F.col("group_n"), F.col("v")), probability(F.col("total"), F.col("lang_n"), F.col("v"))
        valued = cells.withColumns({"p": p, "q": q}).where("p > q").select("lang", "source", "n", "total", "m", divergence(F.col("p"), F.col("q")).alias("value"))
        # Every value has a term, so `ranks` values of a group are enough; Spark cuts them before the shuffle, too.
        values = valued.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
        order = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
        first = values.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= ranks)
        above = F.coalesce(F.sum("m").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        first = first.withColumn("above", above).where(F.col("above") < ranks).select("lang", "source", "value", "above")
        best = valued.drop("m").join(first, ["lang", "source", "value"])
        found = self.rows.join(best, ["lang", "source", "n", "total"])
        within = F.row_number().over(Window.partitionBy("lang", "source", "value").orderBy("term"))
        found = found.withColumn("_r", within).where(F.col("_r") <= ranks)
        return found.select("lang", "source", F.col("term").alias("item"), "value", (F.col("above") + F.col("_r")).cast("int").alias("rank")).where(F.col("rank") <= ranks)

    def pairs(self) -> DataFrame:
        """(lang, source, item, value, rank): each other source of the language with the divergence summed over all kept terms.

        Cells (count here, count there) of terms that both sources have come from the terms; those with a zero follow
        from the sources' own counts, less the cells of common terms. So a term costs the pairs of sources that have
        it, summed before the shuffle, and never those that don't.
        """
        both = self.kept.where(F.size("counts") > 1).select("lang", F.explode("counts").alias("x"), F.col("counts").alias("ys")).select("lang", "x", F.explode(F.filter("ys", lambda y: y["source"] > F.col("x")["source"])).alias("y"))
        common = both.groupBy("lang", F.col("x.source").alias("a"), F.col("y.source").alias("b"), F.col("x.n").alias("n"), F.col("y.n").alias("k")).agg(F.count("*").alias("m"))
        # Common terms, and what they take from the cells with a zero.
        cell = lambda n, k, m: F.struct(n.alias("n"), k.alias("k"), m.alias("m"))
        zero = F.lit(0).cast("long")
        n, k, m = F.col("n"), F.col("k"), F.col("m")
        common = common.select("lang", "a", "b", F.explode(F.array(cell(n, k, m), cell(n, zero, -m), cell(zero, k, -m), cell(zero, zero, m))).alias("c")).select("lang", "a", "b", "c.*")
        # One row a source: Spark broadcasts it if it is small and splits a language with very many terms otherwise.
        other = self.groups.select("lang", F.col("source").alias("other"))
        own = self.cells.groupBy("lang", "source", "n").agg(F.sum("m").alias("m")).join(other, "lang").where("source != other")
        first = F.col("source") < F.col("other")
        pair = (F.least("source", "other").alias("a"), F.greatest("source", "other").alias("b"))
        own = own.select("lang", *pair, F.explode(F.array(F.when(first, cell(n, zero, m)).otherwise(cell(zero, n, m)), cell(zero, zero, -m))).alias("c")).select("lang", "a", "b", "c.*")
        whole = self.groups.select("lang", "source", "v").join(other, "lang").where("source < other").select("lang", F.col("source").alias("a"), F.col("other").alias("b"), zero.alias("n"), zero.alias("k"), F.col("v").alias("m"))
        cells = common.unionByName(own).unionByName(whole).groupBy("lang", "a", "b", "n", "k").agg(F.sum("m").alias("m")).where("m != 0 or (n = 0 and k = 0)")
        side = lambda s: self.groups.select("lang", F.col("source").alias(s), F.col("group_n").alias(f"{s}_n"), *(["v"] if s == "a" else []))
        cells = cells.join(side("a"), ["lang", "a"]).join(side("b"), ["lang", "b"])
        f = divergence(probability(n, F.col("a_n"), F.col("v")), probability(k, F.col("b_n"), F.col("v")))
        value = cells.groupBy("lang", "a", "b").agg(F.coalesce(F.sum(f * m), F.lit(0)).alias("value"))
        ways = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
        rows = value.select("lang", ways.alias("w"), "value").select("lang", "w.*", "value")
        # A group's rows are one for each other source of its language.
        return rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).cast("int"))


def audit(docs: DataFrame) -> DataFrame:
    """(lang, source, part, item, value, rank): parts `pair` (all ranks) and `term` (the first RANKS).

    Null texts, languages and sources count as ''; repeated rows are documents of their own; ids and other columns
    play no part, whatever their names. A language without kept terms has pairs of value 0 and no terms; an empty
    table gives no rows.
    """
    found = Audit(docs)
    part = lambda df, name: df.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(found.pairs(), "pair").unionByName(part(found.top_terms(), "term"))
