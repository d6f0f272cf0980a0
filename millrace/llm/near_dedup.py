"""MinHash near-duplicates by a multi-index Hamming join.

A document is the set of its 5-word shingles. Sets are sketched by 32 MinHash
values of 16 bits. Signatures are cut into 8 chunks of 4 values: with at most 15
values different, some chunk has at most one that differs, so documents are
looked up under each chunk with one value left out (32 keys). That finds every
pair within signature distance 15, and a pair of similarity 0.8 is missed with a
chance near 1e-6. Every link is then confirmed on the full sets.

Equal sets are one class, compared once. Within a key no list of all pairs is
made: members are first confirmed against one of them, the least edited. Members
that are then still in different components meet in blocks, with their sets, and
are compared where what each has for itself alone leaves room for a link and
nothing has joined their components yet. A pair of blocks gives back the links
that joined components, fewer than its members.

Defined cases: a text with 1 to 4 words is one shingle, its whole sequence; null,
empty and blank texts have the empty set and link with nothing; repeated rows are
linked by their equal sets; rows without doc_id link like others but name no
component, and are not kept; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, measured_joins, settle, text_batches, words_of
from millrace.operators.scale import join_per_key

WORDS = 5
CHUNKS, CHUNK = 8, 4
PLACES = CHUNKS * CHUNK
BLOCK = 1024

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_ODD = np.random.default_rng(20).integers(1, 1 << 63, size=PLACES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_S31, _S29, _S48 = np.uint64(31), np.uint64(29), np.uint64(48)


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> _S31)) * by
    return x ^ (x >> _S29)


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of the whole text."""
    words = words_of(text)
    n = len(words)
    if not n:
        return np.zeros(0, dtype=np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=n)
    k = min(WORDS, n)
    found = np.full(n - k + 1, k, dtype=np.uint64)
    for j in range(k):
        found = _mixed(found + hashed[j : n - k + 1 + j], _M1)
    return np.unique(found)


def signature(found: np.ndarray) -> bytes:
    """32 MinHash values, 16 bits each."""
    low = np.array([(found * a).min() for a in _ODD], dtype=np.uint64)
    return (_mixed(low, _M2) >> _S48).astype("<u2").tobytes()


def set_hash(found: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for the set."""
    n = np.uint64(len(found))
    a, b = _mixed(found, _M2).sum(dtype=np.uint64) + n, _mixed(found, _M3).sum(dtype=np.uint64) ^ n
    return int(np.int64(_mixed(np.array([a]), _M1)[0].view(np.int64))), int(b.view(np.int64))


_SKETCH_TYPE = "struct<n:bigint,node:bigint,check:bigint,sig:binary>"


def _sketch(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        found = shingles(text)
        rows.append((len(found), *set_hash(found), signature(found)) if len(found) else (0, 0, 0, None))
    return pd.DataFrame(rows, columns=["n", "node", "check", "sig"])


_SET_TYPE = "struct<node:bigint,check:bigint,found:array<bigint>>"


def _set(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        found = shingles(text)
        rows.append((*(set_hash(found) if len(found) else (0, 0)), found.view(np.int64)))
    return pd.DataFrame(rows, columns=["node", "check", "found"])


def keys_of(sig: bytes) -> list[int]:
    """Each chunk with each of its values left out, numbered."""
    values = np.frombuffer(sig, "<u2").tolist()
    found = []
    for c in range(CHUNKS):
        part = values[c * CHUNK : (c + 1) * CHUNK]
        for j in range(CHUNK):
            a, b, d = part[:j] + part[j + 1 :]
            found.append((c * CHUNK + j) << 48 | a << 32 | b << 16 | d)
    return found


_KEYS_TYPE = "array<bigint>"


def _keys(sigs: pd.Series) -> pd.Series:
    return pd.Series([keys_of(s) for s in sigs], dtype=object)


def _linked(common: Column, a: Column, b: Column, percent: int) -> Column:
    return 100 * common >= percent * (a + b - common)


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("found").alias("_fa"))
    right = sets.select(F.col("node").alias("b"), F.col("found").alias("_fb"))
    both = join_per_key(join_per_key(pairs, left, ["a"], "inner"), right, ["b"], "inner")
    common = F.size(F.array_intersect("_fa", "_fb"))
    return both.filter(_linked(common, F.size("_fa"), F.size("_fb"), percent)).select("a", "b")


def _first_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of the first key that two signatures share, for all of a against all of b; -1 without one."""
    differ = (a[:, None, :] != b[None, :, :]).reshape(len(a), len(b), CHUNKS, CHUNK)
    near = differ.sum(axis=3) <= 1
    chunk = near.argmax(axis=2)
    at = np.take_along_axis(differ, chunk[:, :, None, None], axis=2)[:, :, 0, :].argmax(axis=2)
    return np.where(near.any(axis=2), chunk * CHUNK + at, -1)


LINKS = "a bigint, b bigint"


def _links_in_blocks(percent: int):
    """Links between different components within each (key, block, block) of a sorted stream of rows.

    Full sets are compared here, and a pair only while its two components are
    apart, so what comes out is less than the members of the two blocks.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def links_of(t: dict[str, np.ndarray]) -> tuple[list[int], list[int]]:
        left, right = t["block"] == t["low"], t["block"] == t["high"]
        i, j = np.flatnonzero(left), np.flatnonzero(right)
        sigs = np.stack([np.frombuffer(s, "<u2") for s in t["sig"]])
        ok = (t["component"][i][:, None] != t["component"][j][None, :])
        if t["low"][0] == t["high"][0]:
            ok &= t["node"][i][:, None] < t["node"][j][None, :]
        room = np.minimum(t["shared"][i][:, None], t["shared"][j][None, :])
        room = np.minimum(room, np.minimum(t["n"][i][:, None], t["n"][j][None, :]))
        ok &= 100 * room >= percent * (t["n"][i][:, None] + t["n"][j][None, :] - room)
        for s in range(0, len(i), 128):
            if ok[s : s + 128].any():
                ok[s : s + 128] &= _first_key(sigs[i[s : s + 128]], sigs[j]) == (t["key"][0] >> 48)
        above: dict[int, int] = {}

        def root(c: int) -> int:
            while c in above:
                c = above[c]
            return c

        sets: dict[int, np.ndarray] = {}

        def members(at: int) -> np.ndarray:
            if at not in sets:
                sets[at] = np.frombuffer(t["found"][at], "<i8")
            return sets[at]

        a, b = [], []
        for x, y in zip(*np.nonzero(ok)):
            p, q = int(i[x]), int(j[y])
            one, two = root(int(t["component"][p])), root(int(t["component"][q]))
            if one == two:
                continue
            u, v = members(p), members(q)
            common = len(np.intersect1d(u, v, assume_unique=True))
            if 100 * common >= percent * (len(u) + len(v) - common):
                above[one] = two
                a.append(int(t["node"][p]))
                b.append(int(t["node"][q]))
        return a, b

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["key", "low", "high"]):
            columns = {c: np.array(group.column(c).to_pylist(), dtype=object if c in ("sig", "found") else np.int64) for c in group.schema.names}
            if len(columns["key"]) > 1:
                a, b = links_of(columns)
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=schema)

    return run


def _packed(sets: pd.Series) -> pd.Series:
    return pd.Series([np.sort(np.asarray(s, dtype="<i8")).tobytes() for s in sets], dtype=object)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in a sorted stream, each as one table."""
    held: list[pa.Table] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        columns = [table.column(k).to_numpy() for k in keys]
        change = np.zeros(table.num_rows, dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), table.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            now = tuple(int(c[a]) for c in columns)
            if held and now != last:
                yield pa.concat_tables(held).combine_chunks()
                held = []
            held.append(table.slice(a, b - a))
            last = now
    if held:
        yield pa.concat_tables(held).combine_chunks()


def sketches(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, check, sig) of every document; ``node`` stands for its set."""
    rows = documents.select("doc_id", F.pandas_udf(_sketch, _SKETCH_TYPE)("text").alias("_s"))
    return rows.select("doc_id", F.col("_s.n").alias("n_shingles"), "_s.node", "_s.check", "_s.sig")


def links(documents: DataFrame, sketched: DataFrame, percent: int) -> DataFrame:
    """Confirmed links (a, b) between sets, enough of them to connect all that belongs together."""
    classes = sketched.filter("n_shingles > 0").groupBy("node").agg(
        F.max("n_shingles").alias("n"), F.max("sig").alias("sig"), F.max("check").alias("check")
    )
    classes = settle(classes, "classes")
    keys = classes.select("node", F.explode(F.pandas_udf(_keys, _KEYS_TYPE)("sig")).alias("key"))
    met = keys.groupBy("key").agg(F.count("*").alias("m")).filter("m > 1")
    near = settle(join_per_key(keys, met, ["key"], "inner").select("node", "key"), "keys")
    wanted = classes.join(near.select("node").distinct(), "node").select("node", "check")
    # One document of each wanted class gives the set.
    owners = sketched.join(wanted, ["node", "check"], "left_semi").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    texts = documents.select("doc_id", "text").join(owners.select("doc_id").distinct(), "doc_id", "left_semi")
    # Classes whose documents all lack doc_id have no owner; rows without doc_id bring their sets.
    texts = texts.unionByName(documents.filter("doc_id is null").select("doc_id", "text"))
    # Said not to be deterministic, or the join's null filters run it over the texts a second time, in workers of their own.
    set_of = F.pandas_udf(_set, _SET_TYPE).asNondeterministic()
    sets = texts.select(set_of("text").alias("_s")).select("_s.*").join(wanted, ["node", "check"], "left_semi")
    sets = settle(sets.dropDuplicates(["node"]).select("node", "found"), "sets")
    # Shingles that one class alone has: too many of them rule out any link.
    alone = sets.select("node", F.explode("found").alias("s")).groupBy("s")
    alone = alone.agg(F.count("*").alias("c"), F.min("node").alias("node")).filter("c = 1")
    alone = alone.groupBy("node").agg(F.count("*").alias("u"))
    live = classes.drop("check").join(alone, "node", "left").withColumn("shared", F.col("n") - F.coalesce("u", F.lit(0)))
    live = settle(live.filter(F.col("shared") * 100 >= percent * F.col("n")).drop("u"), "live")
    near = settle(join_per_key(near, live, ["node"], "inner"), "near")
    hubs = near.groupBy("key").agg(F.min(F.struct((F.col("n") - F.col("shared")).alias("own"), F.col("node").alias("hub"), F.col("n").alias("hub_n"))).alias("h"))
    pairs = join_per_key(near.select("node", "n", "key"), hubs, ["key"], "inner")
    fits = F.least("n", "h.hub_n") * 100 >= F.greatest("n", "h.hub_n") * percent
    pairs = pairs.filter(fits).select(F.greatest("node", "h.hub").alias("a"), F.least("node", "h.hub").alias("b"))
    first = settle(confirm(pairs.filter("a <> b").distinct(), sets, percent), "hub-links")
    named = join_per_key(near, components(first).select("node", "component"), ["node"])
    named = named.withColumn("component", F.coalesce("component", "node"))
    mixed = named.groupBy("key").agg(F.count("*").alias("m"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    mixed = mixed.filter("c0 <> c1").select("key", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks"))
    open_rows = join_per_key(named, mixed, ["key"], "inner")
    open_rows = open_rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    open_rows = open_rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    open_rows = open_rows.withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other"))
    order = ["key", "low", "high"]
    packed = sets.select("node", F.pandas_udf(_packed, "binary")("found").alias("found"))
    picked = join_per_key(open_rows, packed, ["node"], "inner")
    picked = picked.select(*order, "block", "node", "component", "n", "shared", "sig", "found")
    picked = picked.repartition(*order).sortWithinPartitions(*order)
    return first.unionByName(settle(picked.mapInArrow(_links_in_blocks(percent), LINKS), "links-between"))


def near_duplicates(documents: DataFrame, percent: int = 85) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Documents are linked where 100 * common shingles >= percent * all shingles of
    the two; ``component_id`` is the smallest doc_id that links lead to.
    """
    text_batches(documents.sparkSession)
    with measured_joins(documents.sparkSession):
        sketched = settle(sketches(documents.select("doc_id", "text")), "sketches")
        joined = components(links(documents, sketched, percent))
    least = sketched.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    # Joined when the caller runs it, where a file of nodes would be sized by its compressed bytes.
    least = join_per_key(least, joined.hint("merge"), ["node"]).withColumn("component", F.coalesce("component", "node"))
    whole = least.groupBy("component").agg(F.min("least").alias("component_id"))
    named = join_per_key(least.select("node", "component"), whole, ["component"]).select("node", "component_id")
    rows = join_per_key(sketched.withColumn("node", F.when(F.col("n_shingles") > 0, F.col("node"))), named, ["node"])
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = rows.select("doc_id", "n_shingles", component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def one_of_each(documents: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without those whose component has a smaller doc_id.

    Rows equal in doc_id and text are cut to one. Of rows that share a doc_id but
    not the text all stay if one does; rows without doc_id stay.
    """
    decided = near_duplicates(documents, percent).filter("doc_id is not null")
    gone = decided.groupBy("doc_id").agg(F.max("kept").alias("kept")).filter("not kept").select("doc_id")
    rows = documents.select("doc_id", F.xxhash64("text").alias("_text"), F.struct(*documents.columns).alias("_row"))
    named = rows.filter("doc_id is not null").join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id", "_text"])
    return named.select("_row.*").unionByName(documents.filter("doc_id is null"))
