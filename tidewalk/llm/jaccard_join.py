"""N-gram Jaccard self-join by a grouped prefix filter, up to connected components.

Method.  A document is the set of its distinct word shingles.  All shingles of all
documents are counted in a hashed table; the counts give one total order, rare first.
Two sets that reach the similarity share a shingle among their first
``n - ceil(t n / 100) + 1`` in that order (their prefixes).

* Equal sets become one class; only its smallest document goes on, and of these only
  sets that a different set can be near enough to.
* Classes with the same prefix and size become one group; only groups are posted
  under their prefix shingles, and shingles that one group alone has are dropped.
* First round: each group meets only the smallest group under each of its shingles,
  and each member only its group's first.  Pairs that the length and position bounds
  leave are tested by parity bitmaps (a lower bound of the symmetric difference), and
  the rest exactly, on whole sets.
* Second round: what the first round has joined needs no further test, so only pairs
  from different components meet, those of a shingle's largest component never among
  themselves.  They are expanded to members and verified likewise.

Nothing is dropped or capped: a link left untested lies inside a component that other
links already hold together.  Keys that hold more than one in 4096 of all rows (a
shingle, a group, a class of copies) are fewer than that; what belongs to them is
broadcast, and where hot shingles' posts meet each other they are salted.  No group is
ever gathered in one task or the driver.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewalk.llm.common import HOT, Workspace, join_by_key, map_arrow
from tidewalk.llm.components import connected_components
from tidewalk.llm.shingles import mix, shingle_sets, sort_each, sums_each

#: log2 of the counting table's cells: enough for 8 million documents, and at most (64 MB of levels go to each worker).
SKETCH_BITS, MOST_SKETCH_BITS = 22, 26
#: The table is summed up in so many parts.
_BLOCKS = 256
#: Parts into which a hot shingle's posts are dealt.
SALTS = 8


@dataclass(frozen=True)
class JaccardParams:
    """``words`` per shingle; two documents link when 100 * intersection >= ``percent`` * union.

    ``sketch_bits``: log2 of the counting table's cells, by the number of documents if None.
    """

    words: int = 5
    percent: int = 80
    sketch_bits: int | None = None


def _partial_counts(words: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, dtype=np.uint32)
        for batch in batches:
            for _, _, hashes, _ in shingle_sets(batch.column("text"), words):
                np.add.at(counts, (hashes >> np.uint64(64 - bits)).astype(np.int64), 1)
        if counts.any():
            part = (1 << bits) // _BLOCKS
            packed = [zlib.compress(counts[k * part : (k + 1) * part].tobytes(), 1) for k in range(_BLOCKS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_BLOCKS), pa.int32()), pa.array(packed, pa.binary())], ["block", "cells"])

    return run


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells"), strict=True):
            more = np.frombuffer(zlib.decompress(cells.as_py()), dtype=np.uint32)
            sums[block] = sums[block] + more if block in sums else more.astype(np.uint64)
    for block, total in sums.items():
        level = np.minimum(np.floor(4 * np.log2(1 + total.astype(np.float64))), 255).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([level.tobytes()], pa.binary())], ["block", "cells"])


def frequency_levels(docs: DataFrame, params: JaccardParams) -> np.ndarray:
    """Log-scaled counts of all shingles of all documents by hash cell (``2**sketch_bits`` bytes).

    A task's table is as large whatever it reads, so there are only a few tasks per core.
    """
    tasks = max(64, 4 * docs.sparkSession.sparkContext.defaultParallelism)
    partial = map_arrow(docs.select("text").coalesce(tasks), _partial_counts(params.words, params.sketch_bits), "block int, cells binary")
    rows = map_arrow(partial.repartition("block"), _sum_counts, "block int, cells binary").collect()
    levels = np.zeros((_BLOCKS, (1 << params.sketch_bits) // _BLOCKS), dtype=np.uint8)
    for block, cells in rows:
        levels[block] = np.frombuffer(cells, dtype=np.uint8)
    return levels.reshape(-1)


def _bitmap(hashes: np.ndarray) -> bytes:
    """Parity of the set's members by low hash bits, about one bit each; two such maps differ in no more bits than the sets in members."""
    width = 1 << max(6, (len(hashes) - 1).bit_length()) if len(hashes) else 64
    cells = (hashes & np.uint64(width - 1)).astype(np.int64)
    return np.packbits((np.bincount(cells, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


_FEATURES = "doc_id long, n long, h1 long, h2 long, p1 long, p2 long, prefix array<long>, bits binary"


def _features(levels, params: JaccardParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, shift = levels.value, np.uint64(64 - params.sketch_bits)
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, hashes, starts in shingle_sets(batch.column("text"), params.words):
                n = np.diff(starts)
                keys = (table[(hashes >> shift).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (hashes >> np.uint64(8))
                sort_each(keys, starts)
                length = np.where(n > 0, n - (params.percent * n + 99) // 100 + 1, 0)
                within = np.arange(len(keys)) - np.repeat(starts[:-1], n)
                first = keys[within < np.repeat(length, n)]
                cuts = np.concatenate([[0], np.cumsum(length)])
                salt = np.uint64(0x51ED270B0A1F39C1)
                sums = [sums_each(mix(x), s) for x, s in ((hashes, starts), (hashes ^ salt, starts), (first, cuts), (first ^ salt, cuts))]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(i, j - i).cast(pa.int64()),
                        pa.array(n, pa.int64()),
                        *(pa.array(s.view(np.int64)) for s in sums),
                        pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(first.view(np.int64))),
                        pa.array([_bitmap(hashes[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)], pa.binary()),
                    ],
                    ["doc_id", "n", "h1", "h2", "p1", "p2", "prefix", "bits"],
                )

    return run


def _sets(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for i, j, hashes, starts in shingle_sets(batch.column("text"), words):
                members = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays([ids.slice(i, j - i).cast(pa.int64()), members], ["doc_id", "members"])

    return run


def _near_by_bits(percent: int):
    """Keep the pairs whose bitmaps leave the similarity possible."""

    def fold(bits: np.ndarray, width: int) -> np.ndarray:
        while bits.shape[1] > width:
            half = bits.shape[1] // 2
            bits = bits[:, :half] ^ bits[:, half:]
        return bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [batch.column(c) for c in ("bits_a", "bits_b")]
            sizes = [np.array(pa.compute.binary_length(x)) for x in raw]
            total = np.array(batch.column("n_a")) + np.array(batch.column("n_b"))
            keep = np.zeros(len(total), dtype=bool)
            for pair in {*zip(*(s.tolist() for s in sizes), strict=True)}:
                rows = np.flatnonzero((sizes[0] == pair[0]) & (sizes[1] == pair[1]))
                step = max(1, (4 << 20) // sum(pair))
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    maps = [np.frombuffer(b"".join(x.take(pa.array(some)).to_pylist()), np.uint8).reshape(len(some), w) for x, w in zip(raw, pair, strict=True)]
                    apart = np.bitwise_count(fold(maps[0], min(pair)) ^ fold(maps[1], min(pair))).sum(axis=1, dtype=np.int64)
                    keep[some] = (100 + percent) * apart <= (100 - percent) * total[some]
            if keep.any():
                yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], ["a", "b"])

    return run


class _Join:
    """The state of one run: its tables and how pairs are tested."""

    def __init__(self, docs: DataFrame, params: JaccardParams, work: Workspace) -> None:
        self.spark: SparkSession = docs.sparkSession
        self.docs = docs.select("doc_id", "text")
        self.work, self.count = work, self.docs.count()
        bits = params.sketch_bits or min(MOST_SKETCH_BITS, SKETCH_BITS + max(0, (self.count >> 23).bit_length()))
        self.params = params = replace(params, sketch_bits=bits)
        levels = self.spark.sparkContext.broadcast(frequency_levels(self.docs, params))
        self.features = work.table(map_arrow(self.docs, _features(levels, params), _FEATURES), "features")

    def possible(self, a: str, b: str, apart: str = "0") -> str:
        """Whether sets of sizes ``a`` and ``b`` can be near enough.

        The sizes' difference, or places of the first common shingle (``apart``), bound
        the symmetric difference from below; different sets of one size differ by 2.
        """
        least = f"greatest({apart}, abs({a} - {b}), if({a} = {b}, 2, 1))"
        return f"{100 + self.params.percent} * {least} <= {100 - self.params.percent} * ({a} + {b})"

    def matched(self, minor: DataFrame, posts: DataFrame, hot: DataFrame) -> DataFrame:
        """Posts that share a shingle; both sides are written tables' rows, and hot shingles' are dealt over ``SALTS`` tasks more."""
        if hot.isEmpty():
            return minor.join(posts, "token")
        few, salts = F.broadcast(hot), F.array(*map(F.lit, range(SALTS)))
        dealt = minor.join(few, "token", "left_semi").withColumn("salt", F.pmod(F.xxhash64("head_a"), F.lit(SALTS)).cast("int"))
        spread = posts.join(few, "token", "left_semi").withColumn("salt", F.explode(salts))
        return minor.join(few, "token", "left_anti").join(posts, "token").unionByName(dealt.join(spread, ["token", "salt"]).drop("salt"))

    def verified(self, pairs: DataFrame, label: str) -> DataFrame:
        """The links among distinct pairs (a, b) of classes, as edges (u, v)."""
        bits = self.classes.select("node", "n", "bits")
        pairs = pairs.join(bits.toDF("a", "n_a", "bits_a"), "a").join(bits.toDF("b", "n_b", "bits_b"), "b")
        pairs = pairs.where(self.possible("n_a", "n_b"))
        near = self.work.table(map_arrow(pairs.select("a", "b", "n_a", "n_b", "bits_a", "bits_b"), _near_by_bits(self.params.percent), "a long, b long"), f"{label}-near")
        wanted = near.select(F.col("a").alias("doc_id")).unionByName(near.select(F.col("b").alias("doc_id"))).distinct()
        sets = map_arrow(self.docs.join(wanted, "doc_id", "left_semi"), _sets(self.params.words), "doc_id long, members array<long>").where(F.size("members") > 0)
        full = near.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
        common = F.size(F.array_intersect("set_a", "set_b"))
        full = full.select("a", "b", common.alias("both"), (F.size("set_a") + F.size("set_b")).alias("sum"))
        links = full.where(f"100 * both >= {self.params.percent} * (sum - both)").select(F.col("a").alias("u"), F.col("b").alias("v"))
        return self.work.table(links, f"{label}-links")

    def components(self) -> DataFrame:
        """(node, component) for the classes that anything links; ``members`` has each document's class."""
        work = self.work
        some = self.features.where("n > 0 and doc_id is not null")
        self.classes = work.table(
            some.groupBy("n", "h1", "h2").agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("p1").alias("p1"), F.first("p2").alias("p2"), F.first("prefix").alias("prefix"), F.first("bits").alias("bits")),
            "classes",
        )
        # A set is linkable if one with a single shingle more would be near enough.
        able = self.classes.where(self.possible("n", "n + 1"))
        slim = able.select("node", "n", "p1", "p2")
        heads = work.table(slim.groupBy("n", "p1", "p2").agg(F.min("node").alias("head"), F.count("*").alias("size")), "heads")
        # Every class with its group; groups of one need no join later on.
        grouped = work.table(join_by_key(slim, heads, ["n", "p1", "p2"], "size", self.classes.count()).select("node", "n", "head", "size"), "groups")
        posted = able.groupBy("n", "p1", "p2").agg(F.min("node").alias("head"), F.first("prefix").alias("prefix")).select("head", "n", F.posexplode("prefix").alias("place", "token"))
        posted = work.table(posted, "posted")
        least = work.table(posted.groupBy("token").agg(F.min(F.struct("head", "n", "place")).alias("hub"), F.count("*").alias("posts")).where("posts > 1"), "least")
        total = posted.count()
        live = work.table(join_by_key(posted, least, ["token"], "posts", total).select("token", "head", "n", "place", "hub"), "live")
        work.drop("heads", "posted", "least")

        meet = live.where("head <> hub.head").where(self.possible("n", "hub.n", "place + hub.place + abs((n - place) - (hub.n - hub.place))"))
        first = meet.select(F.col("hub.head").alias("a"), F.col("head").alias("b"))
        inside = grouped.where("node <> head").where(self.possible("n", "n")).select(F.col("head").alias("a"), F.col("node").alias("b"))
        links = self.verified(first.unionByName(inside).distinct(), "first")
        # Rows that share an id are one document, whatever their texts.
        self.members = work.table(join_by_key(some.select("doc_id", "n", "h1", "h2"), self.classes.select("n", "h1", "h2", "node", "copies"), ["n", "h1", "h2"], "copies", self.count).select("doc_id", "node"), "members")
        split = self.members.groupBy("doc_id").agg(F.min("node").alias("m"), F.max("node").alias("x")).where("m < x")
        same = self.members.join(split, "doc_id").where("node <> m").select(F.col("node").alias("u"), F.col("m").alias("v"))
        joined = connected_components(links.unionByName(same), work, "joined")

        # Second round, between components only.
        placed = work.table(grouped.join(joined, "node", "left").select("node", "n", "head", "size", F.coalesce("component", "node").alias("c")), "placed")
        span = placed.groupBy("head").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
        spread = work.table(live.select("token", "head", "n", "place").join(span, "head"), "spread")
        work.drop("groups", "live")
        # Of each shingle whose posts lie in several components, the component that has most of them.
        by_place = spread.groupBy("token", "lo", "hi").agg(F.count("*").alias("k")).groupBy("token")
        top = F.max(F.when(F.col("lo") == F.col("hi"), F.struct("k", "lo")))
        open_ = by_place.agg(F.min("lo").alias("least"), F.max("hi").alias("most"), F.sum("k").alias("posts"), top.alias("top")).where("least < most")
        open_ = work.table(open_.select("token", "posts", F.col("top.lo").alias("major")), "open")
        posts = work.table(join_by_key(spread, open_, ["token"], "posts", total).drop("posts"), "posts")
        work.drop("spread")
        minor = posts.where("major is null or lo <> major or hi <> major").select("token", *(F.col(c).alias(f"{c}_a") for c in ("head", "n", "place", "lo", "hi")))
        hot = open_.where(F.col("posts") * HOT > total).select("token")
        pairs = self.matched(minor, posts, hot).where("head <> head_a and not (lo = hi and lo_a = hi_a and lo = lo_a)")
        pairs = pairs.where("(lo = hi and lo = major) or head_a < head").where(self.possible("n", "n_a", "place + place_a + abs((n - place) - (n_a - place_a))"))
        pairs = pairs.select(F.least("head", "head_a").alias("ha"), F.greatest("head", "head_a").alias("hb")).distinct()
        of = placed.select(F.col("head").alias("ha"), F.col("node").alias("a"), F.col("c").alias("ca"))
        expanded = pairs.join(of, "ha").join(of.toDF("hb", "b", "cb"), "hb").where("ca <> cb").select("a", "b")
        # Members of one group that the first round has left apart from its first.
        mixed = span.where("lo < hi").select("head")
        within = placed.where("size > 1").where(self.possible("n", "n")).join(mixed, "head", "left_semi")
        lead = within.where("node = head").select("head", F.col("c").alias("major"))
        odd = within.join(lead, "head").where("c <> major").select("head", F.col("node").alias("a"), F.col("c").alias("ca"), "major")
        inside = odd.join(within.select("head", F.col("node").alias("b"), F.col("c").alias("cb")), "head").where("ca <> cb and (cb = major or a < b)").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        more = self.verified(expanded.unionByName(inside).distinct(), "second")
        if more.isEmpty():
            return joined
        stars = joined.where("node <> component").select(F.col("node").alias("u"), F.col("component").alias("v"))
        return connected_components(stars.unionByName(more), work, "all")


def ngram_jaccard_join(docs: DataFrame, params: JaccardParams | None = None) -> DataFrame:
    """Documents that near-equal shingle sets link, as components.

    ``docs`` has ``doc_id`` (integer) and ``text``; other columns are not looked at, so
    clashing names do no harm.  Returns one row per input row: ``doc_id``,
    ``n_shingles`` (size of its set) and ``component_id``, the smallest ``doc_id`` that
    links reach.  Null or wordless text: an empty set, linked with nothing.  A null
    ``doc_id``: its row returns with a null component and takes part in no link.  Rows
    that share a ``doc_id`` are one document.  An empty table gives an empty table.
    """
    params = params or JaccardParams()
    if not 50 <= params.percent <= 100 or params.words < 1 or not math.log2(_BLOCKS) <= (params.sketch_bits or SKETCH_BITS) <= MOST_SKETCH_BITS:
        raise ValueError(f"unusable parameters: {params}")
    work = Workspace(docs.sparkSession, "jaccard")
    run = _Join(docs, params, work)
    found = run.components()
    # By document, not by class: a class of very many equal documents would be one hot key.
    classes = run.classes.select("node", "copies").join(found, "node", "left").select("node", "copies", F.coalesce("component", "node").alias("component"))
    by_doc = join_by_key(run.members, work.table(classes, "found"), ["node"], "copies", run.count).groupBy("doc_id").agg(F.min("component").alias("component"))
    out = run.features.select("doc_id", "n").join(by_doc, "doc_id", "left")
    alone = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    result = work.table(out.select("doc_id", F.col("n").alias("n_shingles"), alone.alias("component_id")), "result")
    work.keep("result")
    return result


def near_duplicate_representatives(docs: DataFrame, params: JaccardParams | None = None) -> DataFrame:
    """The documents with one of each component kept: the one with its smallest id, all columns as they were.

    Of rows that share a kept id one stays: the first by its text (null before all others),
    then by its other columns from left to right, those that have no order left out.
    Rows with a null id stay, since links are between ids.
    """
    by_id = ngram_jaccard_join(docs, params).where("doc_id is not null").groupBy("doc_id")
    odd = by_id.agg((F.min("component_id") != F.col("doc_id")).alias("gone"), F.count("*").alias("rows")).where("gone or rows > 1")
    odd = Workspace(docs.sparkSession, "representatives").table(odd, "odd")
    single = docs.join(odd.select("doc_id"), "doc_id", "left_anti").select(docs.columns)
    repeated = odd.where("not gone").select("doc_id")
    if repeated.isEmpty():
        return single
    ordered = [f.name for f in docs.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    first = F.min_by(F.struct(*docs.columns), F.struct("text", *[c for c in ordered if c != "text"]))
    kept = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(first.alias("row"))
    return single.unionByName(kept.select(*[F.col("row")[c].alias(c) for c in docs.columns]))
