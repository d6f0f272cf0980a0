"""Embedding near-duplicates by iterative quantisation.

A rotation is learned on a bounded sample so that the signs of the rotated,
centred vectors are balanced bits that lose little of the vector (PCA, then
alternating between signs and the orthogonal matrix nearest to them). Codes of 64
bits are looked up in four tables of 16 bits each; a pair is retrieved when in some
table the two parts differ by one bit or none. That finds every pair within
Hamming distance 7. Retrieved pairs are compared by cosine of the original
vectors in double precision.

Equal vectors are one class. Buckets that differ by at most a bit meet block by
block, with the vectors; a block pair gives back a count per vector and a star
per component, never its pairs. Each pair is counted in the first table that
retrieves it.

Defined cases: a vector that is null, empty or zero, or holds null or non-finite
components, or has no label, links with nothing and is its own component; vectors
of different length are never compared; repeated rows are copies of each other; a
row without vec_id counts as a partner, names no component and is not kept; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, settle
from millrace.llm.near_dedup import grouped
from millrace.operators.scale import join_per_key

SAMPLE = 4096
BITS = 64
TABLES = 4
BLOCK = 512
COSINE = 0.98


class Quantiser:
    """Centre and projection whose signs are the code."""

    def __init__(self, centre: np.ndarray, projection: np.ndarray):
        self.centre, self.projection = centre, projection

    @property
    def width(self) -> int:
        """Bits per table."""
        return max(1, -(-self.projection.shape[1] // TABLES))

    @classmethod
    def fit(cls, vectors: np.ndarray, bits: int = BITS, rounds: int = 50, seed: int = 5) -> Quantiser:
        """PCA to ``bits`` dimensions, then the rotation that brings the points nearest to their signs."""
        x = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        centre = x.mean(axis=0)
        bits = min(bits, x.shape[1])
        _, axes = np.linalg.eigh(np.cov(x - centre, rowvar=False).reshape(x.shape[1], x.shape[1]) if len(x) > 1 else np.eye(x.shape[1]))
        main = axes[:, ::-1][:, :bits]
        points = (x - centre) @ main
        turn, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(bits, bits)))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(points @ turn >= 0, 1.0, -1.0).T @ points)
            turn = right.T @ left.T
        return cls(centre, main @ turn)

    def codes(self, vectors: list[np.ndarray]) -> np.ndarray:
        """Codes as 64-bit integers, the bits in order from the lowest; other lengths are padded or cut."""
        n = len(self.centre)
        x = np.zeros((len(vectors), n))
        for i, v in enumerate(vectors):
            v = np.asarray(v, dtype=np.float64)
            x[i, : min(n, len(v))] = v[:n] / (np.linalg.norm(v) or 1.0)
        bits = (x - self.centre) @ self.projection >= 0
        return (bits.astype(np.uint64) << np.arange(bits.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def usable(embedding: Column, label: Column) -> Column:
    """Whether a vector can link at all."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(label.isNotNull() & finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


UNIT = ["label", "dim", "t", "v", "w", "i", "j"]
FOUND = "node bigint, root bigint, n_links bigint"
_FOUND = pa.schema([("node", pa.int64()), ("root", pa.int64()), ("n_links", pa.int64())])


def _differ(a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """First table in which the codes differ by a bit at most, for all of a against all of b; -1 without one."""
    x = a[:, None] ^ b[None, :]
    first = np.full(x.shape, -1, dtype=np.int64)
    for t in reversed(range(TABLES)):
        part = (x >> np.uint64(t * width)) & np.uint64((1 << width) - 1)
        first[(part & (part - np.uint64(1))) == 0] = t
    return first


def _compare(width: int, cosine: float):
    def unit(t: pa.Table) -> pa.RecordBatch | None:
        table, same = t.column("t")[0].as_py(), (t.column("v")[0], t.column("i")[0]) == (t.column("w")[0], t.column("j")[0])
        node, code, copies, right = (t.column(c).to_numpy() for c in ("node", "code", "copies", "right"))
        dim = t.column("dim")[0].as_py()
        vectors = t.column("embedding").combine_chunks()
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        a = np.flatnonzero(~right)
        b = a if same else np.flatnonzero(right)
        if not len(a) or not len(b):
            return None
        codes = code.view(np.uint64)
        link = (x[a] @ x[b].T >= cosine) & (_differ(codes[a], codes[b], width) == table) & (node[a][:, None] != node[b][None, :])
        if not link.any():
            return None
        names = np.unique(np.concatenate([node[a], node[b]]))
        to_a, to_b = np.searchsorted(names, node[a]), np.searchsorted(names, node[b])
        counts = np.zeros(len(names), dtype=np.int64)
        np.add.at(counts, to_a, (link * copies[b][None, :]).sum(axis=1))
        if not same:
            np.add.at(counts, to_b, (link * copies[a][:, None]).sum(axis=0))
        root, high = np.arange(len(names)), len(names)
        while True:
            before = root.copy()
            np.minimum.at(root, to_a, np.where(link, root[to_b][None, :], high).min(axis=1))
            np.minimum.at(root, to_b, np.where(link, root[to_a][:, None], high).min(axis=0))
            if (before == root).all():
                break
        hit = counts > 0
        return pa.RecordBatch.from_arrays([pa.array(names[hit]), pa.array(names[root[hit]]), pa.array(counts[hit])], schema=_FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, UNIT):
            if group.num_rows > 1:
                found = unit(group)
                if found is not None:
                    yield found

    return run


def fit(classes: DataFrame, sample: int = SAMPLE) -> Quantiser | None:
    """Learn from at most ``sample`` distinct vectors, chosen by their hash; None without any."""
    rows = classes.select("node", "dim", "embedding").orderBy("node").limit(sample).collect()
    if not rows:
        return None
    sizes = pd.Series([r["dim"] for r in rows]).value_counts().sort_index()
    dim = int(sizes.idxmax())
    return Quantiser.fit(np.array([r["embedding"] for r in rows if r["dim"] == dim], dtype=np.float64))


def links(classes: DataFrame, model: Quantiser, cosine: float) -> DataFrame:
    """(node, root, n_links) by block pair: links counted there, and one of the nodes they lead to."""
    width = model.width

    def code(vectors: pd.Series) -> pd.Series:
        return pd.Series(model.codes(list(vectors)), dtype="int64")

    coded = classes.withColumn("code", F.pandas_udf(code, "bigint")("embedding"))
    tables = F.array(
        *[F.struct(F.lit(t).alias("t"), F.shiftrightunsigned("code", t * width).bitwiseAND(F.lit((1 << width) - 1)).alias("v")) for t in range(TABLES)]
    )
    members = settle(coded.withColumn("_t", F.explode(tables)).select("*", "_t.*").drop("_t"), "tables")
    bucket = ["label", "dim", "t", "v"]
    sizes = settle(members.groupBy(*bucket).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "buckets")
    flips = F.array(*[F.lit(0).cast("bigint"), *[F.lit(1 << i).cast("bigint") for i in range(width)]])
    asked = sizes.withColumn("w", F.explode(F.transform(flips, lambda f: F.col("v").bitwiseXOR(f)))).filter("v <= w")
    others = sizes.select("label", "dim", "t", F.col("v").alias("w"), F.col("blocks").alias("others"))
    met = asked.join(others, ["label", "dim", "t", "w"])
    met = met.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("others") - 1))).filter("v < w or i <= j").drop("blocks", "others")
    rows = join_per_key(members, sizes, bucket).withColumn("k", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).drop("blocks")
    left = join_per_key(rows.withColumnRenamed("k", "i"), met, [*bucket, "i"], "inner").withColumn("right", F.lit(False))
    apart = met.filter("v < w or i < j")
    right = join_per_key(rows.withColumnRenamed("k", "j").withColumnRenamed("v", "w"), apart, ["label", "dim", "t", "w", "j"], "inner")
    picked = [*UNIT, "right", "node", "code", "copies", "embedding"]
    both = left.select(*picked).unionByName(right.withColumn("right", F.lit(True)).select(*picked))
    both = both.repartition(*UNIT).sortWithinPartitions(*UNIT)
    return settle(both.mapInArrow(_compare(width, cosine), FOUND), "links")


def near_vectors(embeddings: DataFrame, cosine: float = COSINE, sample: int = SAMPLE) -> DataFrame:
    """Per vector: vec_id, n_links, component_id, kept.

    Vectors of one label are linked at a cosine of at least ``cosine``.
    """
    vectors = embeddings.select("vec_id", F.col("label").cast("bigint"), F.col("embedding").cast("array<double>"))
    vectors = vectors.withColumn("node", F.when(usable(F.col("embedding"), F.col("label")), F.xxhash64("label", "embedding")))
    classes = vectors.filter("node is not null").groupBy("label", "embedding", "node").agg(F.count("*").alias("copies"), F.min("vec_id").alias("least"))
    classes = settle(classes.withColumn("dim", F.size("embedding")), "vectors")
    model = fit(classes, sample)
    ids = vectors.select("vec_id", "node")
    if model is None:
        return ids.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = links(classes.drop("least"), model, cosine)
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("node").agg(F.sum("n_links").alias("linked"))
    named = classes.select("node", "copies", "least").join(counts, "node", "left").join(joined, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    whole = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = join_per_key(named, whole, ["component"], "inner")
    named = named.select("node", (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    rows = join_per_key(ids, named, ["node"])
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    rows = rows.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
