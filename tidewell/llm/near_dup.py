"""MinHash near-duplicates by a multi-index Hamming join of b-bit signatures.

A document's signature has SYMBOLS MinHash values of 16 bits. It is split into CHUNKS chunks of WIDTH symbols.
Two signatures that differ in at most 2 * CHUNKS - 1 symbols agree, by the pigeonhole principle, in some chunk
but for at most one symbol. So every chunk is indexed WIDTH times, each time with another symbol left out (the
allowed chunk error), and equal keys give every pair within that distance. A pair at Jaccard 0.75 agrees so in
a given chunk with probability 0.63, in none of the twelve with 6e-6. Pairs are then confirmed on the full sets
of 64-bit shingle hashes.

Groups of copies cost no pairs: equal sets are one node. In each bucket, the nodes are compared with its least
and its greatest node (two pairs a node); the nodes of a bucket of over HOT nodes are dealt over SALTS tasks for
that. Buckets that then still hold nodes of different components are open; open buckets that share nodes form a
cluster, and the nodes outside a cluster's commonest component are compared with the rest of the cluster, full
sets in blocks of bounded size, of which each gives a forest of its links and no pairs. A cluster of over CLUSTER
nodes is worked off bucket by bucket instead, so chance chains of buckets don't add up; either way exactly the
pairs that share a bucket are compared, so the result is the same. Nothing is capped: each pair that shares a
bucket is either in one component already or compared.

Joins shuffle both sides unless one is tiny: no table of a size that goes with the input's passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.llm import bitmaps, shingles
from tidewell.llm.components import components
from tidewell.llm.scratch import Scratch, comparable, own, shuffled, slices, unused

CHUNKS, WIDTH = 12, 5
SYMBOLS = CHUNKS * WIDTH
#: Pairs whose signatures agree in fewer symbols aren't confirmed: at Jaccard 0.75 that is 5 standard deviations off (5e-7).
LEAST_AGREE = 27
#: Similarity in hundredths.
PERCENT = 75
#: Nodes on a side of a block that compares full sets; nodes up to which open buckets are compared as one cluster.
BLOCK, CLUSTER = 256, 50_000
#: Nodes from which a bucket's rows are dealt over several tasks, and over how many.
HOT, SALTS = 1024, 32

_rng = np.random.Generator(np.random.PCG64(20240))
_FACTORS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_OFFSETS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def signatures(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """16-bit MinHash symbols, a row for each text that has shingles."""
    counts = counts[counts > 0]
    starts = np.cumsum(counts) - counts
    out = np.empty((len(counts), SYMBOLS), np.uint16)
    if len(counts):
        for j in range(SYMBOLS):
            least = np.minimum.reduceat(hashes * _FACTORS[j] + _OFFSETS[j], starts)
            out[:, j] = (shingles.mix(least) >> np.uint64(48)).astype(np.uint16)
    return out


def chunk_keys(sigs: np.ndarray) -> np.ndarray:
    """SYMBOLS bucket keys a row: each chunk with each one of its symbols left out."""
    chunked = sigs.reshape(len(sigs), CHUNKS, WIDTH).astype(np.uint64)
    out = np.empty((len(sigs), CHUNKS, WIDTH), np.uint64)
    for left_out in range(WIDTH):
        packed = np.zeros((len(sigs), CHUNKS), np.uint64)
        for j in range(WIDTH):
            if j != left_out:
                packed = (packed << np.uint64(16)) | chunked[:, :, j]
        tag = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(left_out + 1)
        out[:, :, left_out] = shingles.mix(packed + shingles.mix(tag))
    return out.reshape(len(sigs), SYMBOLS)


def set_hash(found: np.ndarray) -> int:
    """One signed 64-bit number for a set of shingle hashes."""
    total = shingles.mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(found))
    return int(shingles.mix(np.array([total], np.uint64)).view(np.int64)[0])


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        texts = _texts(batch["text"])
        sizes, nodes, sigs = [], [], []
        for part in shingles.groups(texts):
            hashes, counts = shingles.shingle_hashes(*shingles.word_hashes(texts[part]))
            rows = iter(signatures(hashes, counts))
            ends = np.cumsum(counts)
            for n, hi in zip(counts, ends, strict=True):
                found = np.unique(hashes[hi - n : hi])
                sizes.append(len(found))
                nodes.append(set_hash(found) if n else None)
                sigs.append(next(rows).tobytes() if n else None)
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["th"], pa.array(sizes, pa.int64()), pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary())], ["doc_id", "th", "n_shingles", "node", "sig"])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SYMBOLS)


_INDEX = "key long, node long, hot boolean"


def _indexer(hot: np.ndarray | None):  # noqa: ANN202
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keys = chunk_keys(_matrix(batch["sig"])).reshape(-1)
            is_hot = np.zeros(len(keys), bool) if hot is None else bitmaps.hits(hot, keys)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.repeat(batch["node"].to_numpy(), SYMBOLS)), pa.array(is_hot)], ["key", "node", "hot"])

    return index


def _alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose signatures and sizes allow the similarity."""
    for batch in slices(batches, 10_000):
        if batch.num_rows:
            a, b = batch["n_a"].to_numpy(), batch["n_b"].to_numpy()
            keep = (100 * np.minimum(a, b) >= PERCENT * np.maximum(a, b)) & ((_matrix(batch["sig_a"]) == _matrix(batch["sig_b"])).sum(1) >= LEAST_AGREE)
            yield batch.select(["a", "salt", "b"]).filter(pa.array(keep))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of (a, b, text of b), those with 100 * intersection >= PERCENT * union of their full sets; a row without b and with a's own text comes before the rows of each a."""
    centre = np.zeros(0, np.uint64)
    for batch in slices(batches):
        keep = []
        for b, found in zip(batch["b"].to_pylist(), shingles.shingle_sets(_texts(batch["text"])), strict=True):
            if b is None:
                centre = found
                keep.append(False)
            else:
                both = len(np.intersect1d(centre, found, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(centre) + len(found) - both))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _across(frame: pd.DataFrame) -> pd.DataFrame:
    """A forest of the links between different components from one side of a block to the other."""
    left, right = frame[frame["side"] == 0], frame[frame["side"] == 1]
    out: list[tuple[int, int]] = []
    if len(left) and len(right):
        sigs = np.frombuffer(b"".join(right["sig"]), np.uint16).reshape(-1, SYMBOLS)
        nodes, sizes = right["node"].to_numpy(), right["n"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in right["found"]]
        both = pd.concat([left["comp"], right["comp"]]).to_numpy()
        names, label = np.unique(both, return_inverse=True)
        group = np.arange(len(names))  # components joined so far in this block
        lefts, rights = label[: len(left)], label[len(left) :]
        for node, comp, n, sig, found in zip(left["node"], lefts, left["n"], left["sig"], left["found"], strict=True):
            mine = np.frombuffer(found, np.uint64)
            fits = (group[rights] != group[comp]) & (100 * np.minimum(sizes, n) >= PERCENT * np.maximum(sizes, n))
            there = np.flatnonzero(fits)
            equal = sigs[there] == np.frombuffer(sig, np.uint16)
            agree = equal.sum(1)
            near = agree >= LEAST_AGREE
            near[near] = equal[near].reshape(-1, CHUNKS, WIDTH).sum(2).max(1) >= WIDTH - 1  # a bucket in common
            for i in there[near][np.argsort(-agree[near], kind="stable")]:
                if group[rights[i]] != group[comp]:
                    at = np.minimum(np.searchsorted(mine, sets[i]), n - 1)
                    shared = np.count_nonzero(mine[at] == sets[i])
                    if 100 * shared >= PERCENT * (n + sizes[i] - shared):
                        out.append((node, nodes[i]))
                        group[group == group[rights[i]]] = group[comp]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = [x.tobytes() for x in shingles.shingle_sets(_texts(batch["text"]))]
        yield pa.RecordBatch.from_arrays([batch["node"], pa.array(found, pa.binary())], ["node", "found"])


class _Run:
    """One run's tables: rows (a document each) and nodes (a distinct shingle set each)."""

    def __init__(self, df: DataFrame, id_col: str, text_col: str):
        self.scratch = Scratch(df.sparkSession, "near_dup")
        self._held: DataFrame | None = None
        self.source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), F.col(text_col).alias("text"))
        self.rows = self.scratch.save(self.source.mapInArrow(_sign, "doc_id long, th long, n_shingles long, node long, sig binary"), "rows")
        first = self.rows.where("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "n_shingles", "sig")).alias("r"))
        self.nodes = self.scratch.save(first.select("node", "r.doc_id", "r.th", F.col("r.n_shingles").alias("n"), "r.sig"), "nodes")

    def held(self) -> DataFrame:
        """(key, hot, lo, hi, n, node) of every bucket with two nodes or more and each of its nodes.

        Sums by task come first, so a large bucket is no large group here. hot goes by a bitmap of fixed size on both
        sides of the join: buckets of over HOT nodes, and few others.
        """
        if self._held is None:
            found = self.nodes.select("node", "sig").mapInArrow(_indexer(None), _INDEX)
            found = found.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count("*").alias("n")).where("n > 1")
            found = self.scratch.save(found, "buckets")
            hot = bitmaps.build(found.where(F.col("n") > HOT), F.col("key"))
            index = self.nodes.select("node", "sig").mapInArrow(_indexer(hot), _INDEX)
            self._held = self.scratch.save(self.spread(index, found.mapInArrow(bitmaps.marker(hot, "key"), "key long, lo long, hi long, n long, hot boolean")), "held")
            self.scratch.drop("buckets")
        return self._held

    def spread(self, rows: DataFrame, by_key: DataFrame) -> DataFrame:
        """Join (key, node, hot, ...) with (key, hot, ...) of one row a key; the rows of hot buckets are dealt over SALTS tasks by their node."""
        salt = F.when(F.col("hot"), F.pmod(F.xxhash64("node"), F.lit(SALTS))).otherwise(0).cast("int")
        every = F.when(F.col("hot"), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        return rows.withColumn("salt", salt).join(shuffled(by_key.withColumn("salt", F.explode(every)).drop("hot")), ["key", "salt"]).drop("salt")

    def texts(self, used: DataFrame, name: str) -> DataFrame:
        """(node, text) of the nodes in used; the scan sends no other texts on, but for a few that share a bit of a bitmap."""
        needed = self.scratch.save(self.nodes.join(shuffled(used), "node", "left_semi").select("node", "doc_id", "th"), f"{name}-needed")
        bitmap = bitmaps.build(needed, F.xxhash64("doc_id", "th"))

        def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(bitmaps.hits(bitmap, batch["k"].to_numpy().view(np.uint64)))).select(["doc_id", "th", "text"])

        found = self.source.withColumn("k", F.xxhash64("doc_id", "th")).mapInArrow(wanted, "doc_id long, th long, text string").alias("s")
        same = F.col("s.doc_id").eqNullSafe(F.col("t.doc_id")) & (F.col("s.th") == F.col("t.th"))
        return found.join(shuffled(needed.alias("t")), same).select("node", "text").dropDuplicates(["node"])

    def stars(self) -> DataFrame:
        """(a, salt, b): every bucket's nodes b with its least and with its greatest node a; those of hot buckets are dealt over SALTS salts by b."""
        ends = F.array(F.col("lo"), F.when(F.col("node") != F.col("lo"), F.col("hi")))
        pairs = self.held().select(F.explode(ends).alias("a"), F.col("node").alias("b"), "hot").where("a != b")
        pairs = pairs.groupBy("a", "b").agg(F.max("hot").alias("hot"))
        return pairs.select("a", F.when(F.col("hot"), F.pmod(F.xxhash64("b"), F.lit(SALTS))).otherwise(0).cast("int").alias("salt"), "b")

    def links(self) -> DataFrame:
        """The pairs of stars that are similar enough by their signatures, confirmed on the full sets.

        An a of very many pairs meets at most 1 / SALTS of them in a task, and is sent there once, not with each pair.
        """
        pairs = self.scratch.save(self.stars(), "star-all")
        sigs = self.nodes.select("node", "n", "sig")
        side = lambda x: sigs.select(F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("sig").alias(f"sig_{x}"))
        centres = pairs.select("a", "salt").distinct().join(shuffled(side("a")), "a")
        pairs = pairs.join(shuffled(side("b")), "b").join(shuffled(centres), ["a", "salt"]).mapInArrow(_alike, "a long, salt int, b long")
        pairs = self.scratch.save(pairs, "star-pairs")
        self.scratch.drop("star-all")
        used = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        texts = self.scratch.save(self.texts(used, "star"), "star-texts")
        of = lambda x: texts.select(F.col("node").alias(x), "text")
        centres = pairs.select("a", "salt").distinct().join(shuffled(of("a")), "a").select("a", "salt", F.lit(None).cast("long").alias("b"), "text")
        both = pairs.join(shuffled(of("b")), "b").select("a", "salt", "b", "text").unionByName(centres)
        both = both.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
        out = self.scratch.save(both.mapInArrow(_confirm, "a long, b long"), "star-links")
        self.scratch.drop("star-texts")
        return out

    def open_links(self, comps: DataFrame) -> DataFrame | None:
        """Links between components inside the buckets that stars left open; None without such buckets."""
        save = self.scratch.save
        held = self.held().where("n > 3").join(shuffled(comps), "node", "left")
        held = save(held.select("key", "hot", "lo", "node", F.coalesce("comp", "node").alias("comp")), "open-index")
        open_ = held.groupBy("key").agg(F.max("hot").alias("hot"), F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 != c2").select("key", "hot")
        held = save(self.spread(held, open_), "open-held")
        self.scratch.drop("open-index")
        if held.isEmpty():
            return None
        chains = held.select(F.col("node").alias("a"), F.col("lo").alias("b")).distinct()
        clusters = save(components(chains, self.scratch, "open-clusters").withColumnRenamed("comp", "cluster"), "open-clusters")
        large = save(clusters.groupBy("cluster").count().where(F.col("count") > CLUSTER).select("cluster"), "open-large")
        members = held.select("node", "comp").distinct()
        rows = members.join(shuffled(clusters), "node").select("node", "comp", F.col("cluster").alias("unit"))
        if not large.isEmpty():
            inside = clusters.join(shuffled(large), "cluster", "left_semi").select("node")
            by_bucket = held.join(shuffled(inside), "node", "left_semi").select("node", "comp", F.xxhash64("key", F.lit("key")).alias("unit"))
            rows = rows.join(shuffled(inside), "node", "left_anti").unionByName(by_bucket)
        rows = save(rows, "open-rows")
        units = rows.groupBy("unit", "comp").agg(F.count("*").alias("n")).groupBy("unit").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("total"))
        units = save(units.select("unit", F.col("top.comp").alias("top"), "total", (F.col("total") - F.col("top.n")).alias("few")).where("few > 0"), "open-units")
        sets = save(self.texts(rows.select("node").distinct(), "open").mapInArrow(_sets, "node long, found binary"), "open-sets")
        block = lambda n: F.pmod(F.xxhash64("node"), F.ceil(n / BLOCK))
        blocks = lambda n: F.sequence(F.lit(0).cast("long"), F.ceil(n / BLOCK) - 1)
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.join(shuffled(units), "unit").repartition(tasks, "node")  # a unit's rows meet in a task, but not what they multiply to
        few = rows.where("comp != top").select("unit", block(F.col("few")).alias("i"), F.explode(blocks(F.col("total"))).alias("j"), F.lit(0).alias("side"), "node", "comp")
        all_ = rows.select("unit", F.explode(blocks(F.col("few"))).alias("i"), block(F.col("total")).alias("j"), F.lit(1).alias("side"), "node", "comp")
        sides = few.unionByName(all_).join(shuffled(self.nodes.select("node", "n", "sig")), "node").join(shuffled(sets), "node")
        return save(sides.groupBy("unit", "i", "j").applyInPandas(_across, "a long, b long"), "open-links")

    def clear(self) -> None:
        """Delete what the last steps no longer read."""
        self.scratch.drop("rows", "nodes", "held", "star-pairs", "star-needed", "star-links", "open-held", "open-clusters", "open-large", "open-rows", "open-units", "open-needed", "open-sets", "open-links", "named")

    def named(self) -> DataFrame:
        """(node, doc_id, th, comp): each node with its first row, ids before none, and its component."""
        links = self.links()
        comps = self.scratch.save(components(links, self.scratch, "star-comps"), "star-comps")
        more = self.open_links(comps)
        if more is not None and not more.isEmpty():
            comps = components(comps.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more), self.scratch, "all-comps")
        return self.scratch.save(self.nodes.join(shuffled(comps), "node", "left").select("node", "doc_id", "th", F.coalesce("comp", "node").alias("comp")), "named")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of documents linked by a Jaccard similarity of at least 0.75 of their sets of five-word shingles.

    Returns for each row of df: doc_id, n_shingles (size of the set), component_id (least doc_id reachable over
    links, the document's own included) and kept (doc_id = component_id).

    Null or blank texts have an empty set and are linked with nothing. Repeated rows are rows of one set, with
    the same component; null ids take part but never become a component_id unless no other id is there (then
    component_id and kept are null). Other columns of df are ignored. An empty df gives an empty result.
    """
    run = _Run(df, id_col, text_col)
    named = run.named()
    least = run.scratch.save(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "least")
    of_node = run.scratch.save(named.join(shuffled(least), "comp").select("node", "component_id"), "of_node")
    out = run.rows.join(shuffled(of_node), "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row of each group of near_duplicates.

    Groups hold rows, whatever their ids: the one with the least id stays, then the one with the least text hash, then
    the least of the other columns (as JSON if there are maps). Rows without an id yield to each other but not to rows with one: of a group
    that has both, one of each stays. Rows with an empty set (null or blank texts) all stay. df's columns may have
    any names; an empty df gives an empty result.
    """
    run = _Run(df, id_col, text_col)
    name, row = unused(df, "_key"), unused(df, "_row")
    key = F.xxhash64("doc_id", "th").alias(name)
    named = run.named()
    first = named.where("doc_id is not null").groupBy("comp").agg(F.min(F.struct("doc_id", "th")).alias("r")).select("r.*")
    no_id = run.rows.where("doc_id is null and node is not null").groupBy("node").agg(F.min("th").alias("th")).join(shuffled(named.select("node", "comp")), "node")
    no_id = no_id.groupBy("comp").agg(F.min("th").alias("th")).select(F.lit(None).cast("long").alias("doc_id"), "th")
    kept = first.unionByName(no_id).unionByName(run.rows.where("node is null").select("doc_id", "th")).select(key)
    kept = run.scratch.save(kept.distinct(), "kept")
    repeated = run.rows.where("node is not null").groupBy(key).count().where("count > 1").join(shuffled(kept), name, "left_semi").select(name)
    repeated = run.scratch.save(repeated, "kept-repeated")
    run.clear()
    out = df.withColumn(name, F.xxhash64(F.col(id_col).cast("long"), F.xxhash64(text_col))).join(shuffled(kept), name, "left_semi")
    if repeated.isEmpty():
        return out.select(*own(df))
    least = out.join(shuffled(repeated), name, "left_semi").groupBy(name).agg(F.min_by(F.struct(*own(df)), comparable(df)).alias(row))
    return out.join(shuffled(repeated), name, "left_anti").select(*own(df)).unionByName(least.select(f"{row}.*"))
