"""Hard negatives of anchor vectors by a secondary sort.

Every pair score that can matter becomes one packed key (anchor, descending score,
kind, id). Keys are partitioned by anchor and sorted within partitions, so a
partition is read as a stream: a positive opens a window of allowed negative scores,
a negative that falls into an open window is given out, and no anchor's rows are held.
Positives stand before negatives of the same score, so a window is open before the
first row that it can take.

Vectors are packed into blocks of up to ``BLOCK_ROWS`` rows and anchors into blocks of
up to ``ANCHOR_ROWS``; blocks are dealt to stripes, and every block of anchors meets
every stripe. Of a block only what can still be among the first is sent on: the first
``positives`` rows of the anchor's label, then, once the windows are known, the first
``negatives`` rows of each window. What is shuffled is a few keys per anchor and block,
whatever the number of rows of a label.

Defined cases: rows without a vec_id, a label or a vector, and vectors with a null or
non-finite component, take no part; vectors meet those of their own length only;
rows with equal vec_id are rows of their own (each is an anchor, and another row for
the others); a score beyond a 64-bit integer counts as the nearest one; a window of a
negative positive score is empty; an empty table gives no row; extra columns are
ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows, settle

POSITIVES, NEGATIVES = 5, 3
#: Bounds of a negative's score, in hundredths of the positive's.
LEAST, MOST = 50, 95
BLOCK_ROWS, ANCHOR_ROWS, TILE_ROWS = 32_768, 1024, 4096
SCALE = 256

_LOW, _HIGH = -(2**63), 2**63 - 1
# Anchor's block, place in it and vec_id; score from the top; positive or negative; vec_id and row of the other.
_KEY = struct.Struct(">QIQQBQQ")
_PLACES = np.dtype([("block", ">u8"), ("place", ">u4"), ("anchor", ">u8"), ("below", ">u8"), ("kind", "u1"), ("id", ">u8"), ("row", ">u8")])
_ANCHOR_BYTES = 20

BLOCKS = "block bigint, dim int, n int, kind string, vectors binary, ids binary, labels binary, row_ids binary"
KEYS = "block bigint, place int, key binary"
FOUND = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"


def _batch(schema: str, columns: list) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    named = [part.split() for part in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, named)], names=[n for n, _ in named])


def whole_numbers(values: np.ndarray) -> np.ndarray:
    """floor(256 * x), in the narrowest type that holds all of them exactly."""
    scaled = np.floor(values.astype(np.float64) * SCALE)
    most = np.abs(scaled).max(initial=0)
    return scaled.astype("<i2" if most < 2**15 else "<i4" if most < 2**31 else "<f8")


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers, held within 64 bits."""
    bound = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * max(1, a.shape[1])
    if bound < 2**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side.tolist()] for side in (a, b)]
    exact = [[max(_LOW, min(_HIGH, sum(x * y for x, y in zip(p, q)))) for q in whole[1]] for p in whole[0]]
    return np.array(exact, dtype=np.int64).reshape(len(a), len(b))


def window(score: int) -> tuple[int, int]:
    """Least and greatest negative score that a positive score allows."""
    return -(-LEAST * score // 100), MOST * score // 100


class _Block:
    """Vectors of one length with their ids, labels and row numbers."""

    def __init__(self, n: int, dim: int, kind: str, vectors: bytes, ids: bytes, labels: bytes, row_ids: bytes):
        self.vectors = np.frombuffer(vectors, kind).reshape(n, dim)
        self.ids, self.labels, self.row_ids = (np.frombuffer(x, "<i8") for x in (ids, labels, row_ids))

    @staticmethod
    def row(block: int, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, row_ids: np.ndarray) -> list:
        """A row of ``BLOCKS``, in the order of ids, so that places break ties."""
        order = np.lexsort((row_ids, ids))
        parts = [x[order].astype("<i8").tobytes() for x in (ids, labels, row_ids)]
        return [block, vectors.shape[1], len(ids), vectors.dtype.str, vectors[order].tobytes(), *parts]


class _Packer:
    """Gathers vectors by length and gives out full blocks."""

    def __init__(self, rows: int):
        self.rows, self.held, self.given = rows, {}, 0
        self.first = TaskContext.get().partitionId() << 24

    def add(self, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, row_ids: np.ndarray) -> Iterator[pa.RecordBatch]:
        for start in range(0, len(ids), self.rows):
            part = tuple(x[start : start + self.rows] for x in (vectors, ids, labels, row_ids))
            held = self.held.setdefault(vectors.shape[1], [])
            if sum(len(p[1]) for p in held) + len(part[1]) > self.rows:
                yield self._row(held)
                held.clear()
            held.append(part)

    def rest(self) -> Iterator[pa.RecordBatch]:
        for held in self.held.values():
            if held:
                yield self._row(held)

    def _row(self, held: list) -> pa.RecordBatch:
        row = _Block.row(self.first + self.given, *(np.concatenate(c) for c in zip(*held)))
        self.given += 1
        return _batch(BLOCKS, [[v] for v in row])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (vec_id, label, embedding) to blocks."""
    packer, seen = _Packer(BLOCK_ROWS), TaskContext.get().partitionId() << 40
    for batch in batches:
        ids, labels = (batch.column(i).to_numpy() for i in (0, 1))
        lists, row_ids = batch.column(2), seen + np.arange(len(ids))
        lengths = np.diff(lists.offsets.to_numpy())
        flat, seen = lists.flatten().to_numpy(zero_copy_only=False), seen + len(ids)
        starts = np.cumsum(lengths) - lengths
        for dim in np.unique(lengths):
            mine = np.flatnonzero(lengths == dim)
            values = flat[starts[mine][:, None] + np.arange(dim)] if dim else np.zeros((len(mine), 0))
            yield from packer.add(whole_numbers(values), ids[mine], labels[mine], row_ids[mine])
    yield from packer.rest()


def _anchors(every: int):
    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The anchors among the rows of blocks, in blocks of their own."""
        packer = _Packer(ANCHOR_ROWS)
        for batch in batches:
            for row in batch.to_pylist():
                block = _Block(*(row[c] for c in ("n", "dim", "kind", "vectors", "ids", "labels", "row_ids")))
                at = np.flatnonzero(block.ids % every == 0)
                if len(at):
                    yield from packer.add(block.vectors[at], block.ids[at], block.labels[at], block.row_ids[at])
        yield from packer.rest()

    return pick


def _first(scores: np.ndarray, places: np.ndarray, count: int) -> np.ndarray:
    """The first ``count`` places by descending score, then by place."""
    if len(places) > count:
        cut = np.partition(scores[places], len(places) - count)[len(places) - count]
        places = places[scores[places] >= cut]
    return places[np.argsort(-scores[places].astype(object) if scores.min(initial=0) == _LOW else -scores[places], kind="stable")[:count]]


def _keys(block: int, anchors: _Block, found: list[tuple[int, int, np.ndarray]], others: _Block, kind: int) -> pa.RecordBatch:
    """Packed keys of (anchor's place, score, place of the other)."""
    at, score, other = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
    packed = np.empty(len(at), dtype=_PLACES)
    sign = np.uint64(1 << 63)
    packed["block"], packed["place"], packed["kind"] = block, at, kind
    packed["anchor"] = anchors.ids[at].astype(np.uint64) ^ sign
    packed["below"] = ~(score.astype(np.uint64) ^ sign)
    packed["id"], packed["row"] = others.ids[other].astype(np.uint64) ^ sign, others.row_ids[other].astype(np.uint64)
    raw = packed.tobytes()
    return _batch(KEYS, [np.full(len(at), block), at.astype(np.int32), [raw[i : i + _KEY.size] for i in range(0, len(raw), _KEY.size)]])


def _scored(positives: int, negatives: int, mine: bool):
    """Pairs of blocks to keys: first rows of the anchor's label, or first rows of its windows."""

    def tile(anchors: _Block, others: _Block, start: int, windows: dict[int, list[int]]) -> Iterator[tuple]:
        stop = min(start + TILE_ROWS, len(others.ids))
        products, labels = inner_products(anchors.vectors, others.vectors[start:stop]), others.labels[start:stop]
        same = {label: np.flatnonzero(labels == label) for label in np.unique(anchors.labels).tolist()}
        rest = {} if mine else {label: np.flatnonzero(labels != label) for label in same}
        for at, (label, row) in enumerate(zip(anchors.labels.tolist(), anchors.row_ids.tolist())):
            scores = products[at]
            if mine:
                places = same[label]
                kept = _first(scores, places[others.row_ids[start + places] != row], positives)
            else:
                places, taken = rest[label], []
                for low, high in {window(p) for p in windows.get(at, ())}:
                    inside = scores[places]
                    taken.append(_first(scores, places[(inside >= low) & (inside <= high)], negatives))
                kept = np.unique(np.concatenate(taken)) if taken else places[:0]
            if len(kept):
                yield np.full(len(kept), at), scores[kept], start + kept

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("n", "dim", "kind", "vectors", "ids", "labels", "row_ids")
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i] for name in batch.schema.names}
                others = _Block(*(row[c].as_py() for c in names))
                anchors = _Block(*(row[f"a_{c}"].as_py() for c in names))
                windows: dict[int, list[int]] = {}
                for w in [] if mine else row["a_windows"].as_py() or []:
                    windows.setdefault(w["place"], []).append(w["score"])
                for start in range(0, len(others.ids), TILE_ROWS):
                    yield _keys(row["a_block"].as_py(), anchors, list(tile(anchors, others, start, windows)), others, 0 if mine else 1)

    return pairs


def _read(key: bytes) -> tuple[int, int, int, int, int]:
    """Place and id of the anchor, score, kind, id of the other."""
    _, place, anchor, below, kind, other, _ = _KEY.unpack(key)
    return place, anchor + _LOW, _HIGH - below, kind, other + _LOW


def _opened(positives: int):
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the sorted keys, the first positives of each anchor."""
        anchor, seen = None, 0
        for batch in batches:
            out: list = []
            for block, key in zip(batch.column("block").to_pylist(), batch.column("key").to_pylist()):
                if key[:_ANCHOR_BYTES] != anchor:
                    anchor, seen = key[:_ANCHOR_BYTES], 0
                if seen < positives:
                    place, _, score, _, _ = _read(key)
                    out.append((block, place, score, key))
                seen += 1
            yield _batch("block bigint, place int, score bigint, key binary", list(zip(*out)) or [[]] * 4)

    return first


def _mined(positives: int, negatives: int):
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Windows open and close along the sorted keys; holds ``positives`` windows."""
        anchor, windows = None, []
        for batch in batches:
            out: list = []
            for key in batch.column("key").to_pylist():
                if key[:_ANCHOR_BYTES] != anchor:
                    anchor, windows = key[:_ANCHOR_BYTES], []
                _, anchor_id, score, kind, other = _read(key)
                if kind == 0:
                    windows.append([other, score, 0])
                    continue
                for opened in windows:
                    positive, top, taken = opened
                    if taken < negatives and LEAST * top <= 100 * score <= MOST * top:
                        opened[2] = taken + 1
                        out.append((anchor_id, positive, taken + 1, other, top, score))
            yield _batch(FOUND, list(zip(*out)) or [[]] * 6)

    return stream


def _by_anchor(keys: DataFrame) -> DataFrame:
    """The secondary sort: partitioned by anchor, sorted by the packed key."""
    count = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return keys.repartition(count, "block", "place").sortWithinPartitions("key")


def usable(embedding: Column) -> Column:
    """A vector whose components are all finite."""
    infinite = F.lit(float("inf"))
    return embedding.isNotNull() & F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != infinite))


def mine(
    vectors: DataFrame, every: int = 50, positives: int = POSITIVES, negatives: int = NEGATIVES, label: str = "label"
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose vec_id is divisible by ``every``. For each of an anchor's first
    ``positives`` rows of its label, the first ``negatives`` rows of other labels whose score
    lies between ``LEAST`` and ``MOST`` hundredths of the positive's.
    """
    spark = vectors.sparkSession
    rows = vectors.select("vec_id", F.col(label).cast("bigint").alias("label"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    with arrow_rows(spark, 1000):
        blocks = settle(rows.mapInArrow(_pack, BLOCKS), "vector-blocks")
    with arrow_rows(spark, 4):
        anchors = settle(blocks.mapInArrow(_anchors(every), BLOCKS), "anchor-blocks")
        # The task that wrote a block and its number there deal it to a stripe.
        stripes = max(1, min(blocks.count(), 2 * spark.sparkContext.defaultParallelism))
        dealt = (F.shiftright("block", 24) + F.col("block").bitwiseAND((1 << 24) - 1)) % stripes
        striped = blocks.withColumn("stripe", dealt).drop("block")
        copies = anchors.withColumn("stripe", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(stripes - 1).cast("bigint"))))
        copies = copies.select("stripe", *[F.col(c).alias(f"a_{c}") for c in anchors.columns])
        meets = (F.col("stripe") == F.col("a_stripe")) & (F.col("dim") == F.col("a_dim"))

        def pairs(side: DataFrame) -> DataFrame:
            return striped.join(side.withColumnRenamed("stripe", "a_stripe"), meets).drop("stripe", "a_stripe")

        nearest = settle(pairs(copies).mapInArrow(_scored(positives, negatives, True), KEYS), "positive-keys")
        opened = "block bigint, place int, score bigint, key binary"
        opened = settle(_by_anchor(nearest).mapInArrow(_opened(positives), opened), "windows")
        windows = opened.groupBy(F.col("block").alias("a_block")).agg(F.collect_list(F.struct("place", "score")).alias("a_windows"))
        wanted = copies.join(windows, "a_block")
        tried = settle(pairs(wanted).mapInArrow(_scored(positives, negatives, False), KEYS), "negative-keys")
    keys = opened.select("block", "place", "key").unionByName(tried)
    return _by_anchor(keys).select("key").mapInArrow(_mined(positives, negatives), FOUND)


def stirred_labels(vectors: DataFrame) -> DataFrame:
    """Labels of the registered query: every seventh row moves to the next of ten labels."""
    label = F.col("label").cast("bigint")
    return vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
