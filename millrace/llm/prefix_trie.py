"""Trie of the prefixes that conversations share, with totals of every subtree.

A node is a distinct sequence of first turns; conversations that start with it are its
members. Nodes are told by a sum of hashes of (place, turn), built up by a prefix scan
over slices, so a conversation of any length is shared out among tasks. Nodes with equal
members form a chain without branches, named by (smallest member, number of members);
the tree of chains has at most two nodes for a conversation.

Totals of subtrees are found by time-forward processing. Chains are sorted by reverse
level; each takes the messages that its children have sent from a priority queue, adds
its own share and sends the sum on to its parent. Chains of at most ``shard_members``
members below one with more are a shard, so a shard is a whole subtree and never large;
the few chains above the shards are processed the same way in a second run, which gets
one sum per chain from the shards below it. The queue holds ``QUEUE_ITEMS`` messages in
memory and the rest in sorted runs on disk.

Defined cases: rows without a conv_id take no part; turns are ordered by turn (null
first), role and text; null role or text is empty; repeated rows are turns of their own;
a conversation may be of any length; a table without conversations has no root and gives
no row; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import settle
from millrace.operators.scale import join_per_key, with_position, with_running

#: Messages a queue keeps in memory, and conv_ids in one piece of a list that is hashed.
QUEUE_ITEMS, ENDS_CHUNK = 200_000, 4096
SHARD_MEMBERS = 256
NO_ENDS = hashlib.sha256(b"").hexdigest()

NODE = ["depth", "node"]
CHAIN = ["conv_id", "n_convs"]
TOTALS = "conv_id bigint, n_convs bigint, parent_id bigint, parent_convs bigint, n_children bigint, n_leaves bigint, saved bigint"


class SpillingQueue:
    """A priority queue of five whole numbers; what memory does not hold lies in sorted runs on disk."""

    RECORD = struct.Struct("<5q")

    def __init__(self, limit: int = QUEUE_ITEMS):
        self.limit, self.heap, self.heads = limit, [], []
        self.runs: list[Iterator[tuple]] = []

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        for item in sorted(self.heap):
            file.write(self.RECORD.pack(*item))
        self.heap = []
        file.seek(0)
        run = self._read(file)
        heapq.heappush(self.heads, (next(run), len(self.runs)))
        self.runs.append(run)

    def _read(self, file) -> Iterator[tuple]:
        with file:
            while raw := file.read(self.RECORD.size * 1024):
                yield from self.RECORD.iter_unpack(raw)

    def __bool__(self) -> bool:
        return bool(self.heap or self.heads)

    def take(self, key: tuple) -> Iterator[tuple]:
        """Remove and give the messages whose first numbers are ``key``, which must not be behind."""
        wide = len(key)
        while self.heads and self.heads[0][0][:wide] == key:
            item, run = heapq.heappop(self.heads)
            following = next(self.runs[run], None)
            if following is not None:
                heapq.heappush(self.heads, (following, run))
            yield item
        while self.heap and self.heap[0][:wide] == key:
            yield heapq.heappop(self.heap)


def _forward(limit: int):
    """Time-forward processing of sorted chains; a change of shard starts anew."""
    names = [part.split()[0] for part in TOTALS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue = None, SpillingQueue(limit)
        for batch in batches:
            out = []
            columns = ("shard", "conv_id", "n_convs", "top", "own", "parent_id", "parent_convs", "parent_top", "n_children", "n_leaves", "saved")
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                mine, conv, convs, top, own, parent, parent_convs, parent_top, children, leaves, saved = row
                if mine != shard:
                    if queue:
                        raise RuntimeError("messages are left for chains that are not in the shard")
                    shard = mine
                for _, _, _, below, kept in queue.take((-top, conv, convs)):
                    children, leaves, saved = children + 1, leaves + below, saved + kept
                leaves, saved = leaves or 1, saved + own
                if parent_top is not None:
                    queue.push((-parent_top, parent, parent_convs, leaves, saved))
                out.append((conv, convs, parent, parent_convs, children, leaves, saved))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [[]] * len(names))], names=names)
        if queue:
            raise RuntimeError("messages are left for chains that are not in the shard")

    return run


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Conversations as the registered query wants them: (conv_id, place, said, size, n_turns), and those without turns.

    The first h turns of conversation c - c % 100, then c's own after its first h, with
    h = crc32(c) % 6. A conversation left without turns has one row without a place.
    """
    clean = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    placed = with_position(clean.filter("conv_id is not null"), ["conv_id"], ["turn", "role", "text"], "place")
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    turns = settle(placed.select("conv_id", "place", said.alias("said"), F.length("text").cast("bigint").alias("size")), "turns")
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = convs.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % 6).withColumn("base", F.col("conv_id") - F.col("conv_id") % 100)
    heads = turns.filter("conv_id % 100 = 0 and place < 5").withColumnRenamed("conv_id", "base")
    counts = heads.groupBy("base").agg(F.count("*").alias("there"))
    convs = convs.join(counts, "base", "left").withColumn("given", F.least("h", F.coalesce("there", F.lit(0))))
    convs = settle(convs.withColumn("n_turns", F.col("given") + F.greatest(F.col("own") - F.col("h"), F.lit(0))), "convs")
    first = convs.join(heads, "base").filter("place < h").select("conv_id", "place", "said", "size", "n_turns")
    after = join_per_key(turns, convs, ["conv_id"], "inner").filter("place >= h")
    after = after.select("conv_id", (F.col("place") - F.col("h") + F.col("given")).alias("place"), "said", "size", "n_turns")
    bare = convs.filter("n_turns = 0").select("conv_id", "n_turns")
    return first.unionByName(after).unionByName(bare, allowMissingColumns=True)


def _steps(turns: DataFrame) -> DataFrame:
    """A row per conversation and depth: (conv_id, depth, node, parent, size, ends).

    A node's number is the sum of 92-bit hashes of (place, turn) of its turns.
    """
    bits = [F.shiftrightunsigned(F.xxhash64(F.lit(seed), "place", "said"), 18).cast("decimal(20,0)") for seed in (1, 2)]
    term = (bits[0] * F.lit(2**46).cast("decimal(15,0)") + bits[1]).cast("decimal(28,0)")
    number = lambda column: F.coalesce(column, F.lit(0)).cast("decimal(38,0)")
    told = with_running(turns.filter("place is not null"), ["conv_id"], ["place"], term, F.sum, "before")
    told = told.select(
        "conv_id", (F.col("place") + 1).alias("depth"), (number(F.col("before")) + term).cast("decimal(38,0)").alias("node"),
        number(F.col("before")).alias("parent"), "size", (F.col("place") + 1 == F.col("n_turns")).alias("ends"),
    )
    roots = turns.filter("place is null or place = 0").select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), number(F.lit(0)).alias("node"), F.lit(None).cast("decimal(38,0)").alias("parent"),
        F.lit(0).cast("bigint").alias("size"), F.col("place").isNull().alias("ends"),
    )
    return told.unionByName(roots)


def _ends(steps: DataFrame) -> DataFrame:
    """Per node that is a conversation's last: the hash of those conversations' ids in order.

    The list is put together in pieces; a task that hashes a node reads a row per piece.
    """
    ends = with_position(steps.filter("ends").select(*NODE, "conv_id"), NODE, ["conv_id"], "at")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    pieces = ends.groupBy(*NODE, F.floor(F.col("at") / ENDS_CHUNK).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, told = None, None
        names, kinds = [*NODE, "ends_sha256"], [pa.int64(), pa.decimal128(38, 0), pa.string()]

        def rows(found: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found) if found else [[]] * 3, kinds)], names=names)

        for batch in batches:
            done = []
            for depth, node, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids"))):
                if (depth, node) == key:
                    told.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, told.hexdigest()))
                key, told = (depth, node), hashlib.sha256(ids.encode())
            yield rows(done)
        if key is not None:
            yield rows([(*key, told.hexdigest())])

    count = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = pieces.repartition(count, *NODE).sortWithinPartitions(*NODE, "piece")
    return ranged.mapInArrow(hashed, "depth bigint, node decimal(38,0), ends_sha256 string")


def _chains(nodes: DataFrame) -> DataFrame:
    """Runs of nodes with equal members: where they begin and end, what they save, and the run above."""
    runs = nodes.groupBy(*CHAIN).agg(
        F.min("depth").alias("top"), F.max("depth").alias("bottom"), F.sum("own").alias("own"),
        F.max_by("node", "depth").alias("last"), F.min_by("parent", "depth").alias("node"),
    )
    above = runs.select(
        F.col("bottom").alias("depth"), F.col("last").alias("node"), F.col("conv_id").alias("parent_id"),
        F.col("n_convs").alias("parent_convs"), F.col("top").alias("parent_top"),
    )
    return join_per_key(runs.withColumn("depth", F.col("top") - 1), above, NODE).drop(*NODE, "last")


def _subtree_totals(chains: DataFrame, steps: DataFrame, nodes: DataFrame, members: int, limit: int) -> DataFrame:
    """(conv_id, n_convs, n_children, n_leaves, saved) of every chain, of its whole subtree."""
    spark = chains.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # A conversation's shard starts below the last of its nodes that has too many members.
    large = nodes.filter(F.col("n_convs") > members).select(*NODE, F.lit(True).alias("large"))
    own = join_per_key(steps.select("conv_id", *NODE), large, NODE).filter("large is null")
    shard = own.groupBy("conv_id").agg(F.min_by(F.struct(*NODE), "depth").alias("shard"))
    none = F.lit(0).cast("bigint")
    start = chains.withColumns({"n_children": none, "n_leaves": none, "saved": none})
    light = join_per_key(start.filter(F.col("n_convs") <= members), shard, ["conv_id"], "inner")
    light = light.withColumn("parent_top", F.when(F.col("parent_convs") <= members, F.col("parent_top")))
    light = light.withColumn("shard", F.concat_ws("/", "shard.depth", F.col("shard.node").cast("string")))
    level = ["shard", F.desc("top"), "conv_id", "n_convs"]
    light = light.repartition(count, "shard").sortWithinPartitions(*level)
    below = settle(light.mapInArrow(_forward(limit), TOTALS), "shard-totals")
    sent = below.filter(F.col("parent_convs") > members).groupBy("parent_id", "parent_convs").agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
    )
    sent = sent.select(F.col("parent_id").alias("conv_id"), F.col("parent_convs").alias("n_convs"), "n_children", "n_leaves", "saved")
    upper = chains.filter(F.col("n_convs") > members).join(sent, CHAIN, "left").fillna(0, ["n_children", "n_leaves", "saved"])
    upper = upper.withColumn("shard", F.lit("")).repartition(1).sortWithinPartitions(*level)
    return below.unionByName(upper.mapInArrow(_forward(limit), TOTALS)).drop("parent_id", "parent_convs")


def prefix_trie(turns: DataFrame, shard_members: int | None = None, queue_items: int = QUEUE_ITEMS) -> DataFrame:
    """Nodes of the trie of (conv_id, place, said, size, n_turns), as ``rebuilt`` gives them.

    ``said`` tells turns apart, ``size`` is what sharing a turn saves. Returns
    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256). ``shard_members`` is the square root of the number of conversations
    unless named, which keeps shards and what is above them small alike.
    """
    steps = settle(_steps(turns), "steps")
    nodes = steps.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("size").alias("size"), F.min("parent").alias("parent")
    )
    nodes = settle(nodes.withColumn("own", (F.col("n_convs") - 1) * F.col("size")).drop("size"), "nodes")
    chains = settle(_chains(nodes), "chains")
    members = shard_members or max(SHARD_MEMBERS, isqrt(steps.filter("depth = 0").count()))
    totals = _subtree_totals(chains, steps, nodes, members, queue_items)
    known = join_per_key(chains.select(*CHAIN, "top", "bottom", "parent_id"), totals, CHAIN, "inner")
    told = with_running(nodes.select(*NODE, *CHAIN, "own"), CHAIN, ["depth"], F.col("own"), F.sum, "above")
    told = join_per_key(told, known, CHAIN, "inner")
    told = join_per_key(told, _ends(steps), NODE)
    return told.select(
        "conv_id", "depth", F.when(F.col("depth") > F.col("top"), F.col("conv_id")).otherwise(F.col("parent_id")).alias("parent_conv_id"),
        "n_convs", F.when(F.col("depth") < F.col("bottom"), F.lit(1).cast("bigint")).otherwise(F.col("n_children")).alias("n_children"), "n_leaves",
        (F.col("saved") - F.coalesce("above", F.lit(0))).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
