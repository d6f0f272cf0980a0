"""Removal of repeated passages with a logarithmic family of suffix arrays.

The index holds sampled suffixes. Of the 24-byte strings that start in a 50-byte
window, the one with the least hash is its anchor; equal windows have the same
anchor at the same place, so every match of 50 bytes is an equal stretch around
equal anchors. A batch of documents (a block of ascending doc_id) sorts its
anchored suffixes by the hash of their first 24 bytes and then by a hash of the
stretch that the anchor's windows cover: that is the batch's suffix array, in
hash order. It is merge-scanned against the levels that exist, for matches with
earlier documents, and becomes a level; levels of equal size are merged.

Hash order spreads the suffixes evenly, so the family is cut by hash prefix and
each cut is built by its own task. A suffix is sent once per block however often
it occurs there, and what comes back is a code per suffix sent.

Two scans answer all windows. The first finds stretches met before as a whole.
Where only the anchor was met with different text around it, the second looks
up that anchor's 50-byte windows one by one in the same way.

Hashes have 64 bits and more per comparison; see ``Family``. Matches never cross
documents, and every string is judged on the input, not on what is left.

Defined cases: null and empty texts have no bytes; texts under 50 bytes lose
nothing; rows with equal doc_id do not count for each other, nor does a document
for itself; rows without doc_id come after all others; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import task_count

LENGTH = 50
ANCHOR = 24
WINDOWS = LENGTH - ANCHOR + 1
BLOCK_BYTES = 6 << 20
BUCKET_BYTES = 12 << 20
SEGMENT = 1 << 19
LAST = (1 << 63) - 1

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
_S31, _S29, _S24 = np.uint64(31), np.uint64(29), np.uint64(24)
_BASE = 0xD6E8FEB86659FD93
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray, by: np.uint64) -> np.ndarray:
    x = (x ^ (x >> _S31)) * by
    return x ^ (x >> _S29)


def _powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    found = np.empty(n, dtype=np.uint64)
    found[0] = 1
    have = 1
    while have < n:
        more = min(have, n - have)
        found[have : have + more] = found[:more] * np.uint64(pow(base, have, 1 << 64))
        have += more
    return found


_UP: list[np.ndarray] = []


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _UP or len(_UP[0]) < n:
        _UP[:] = [_powers(_BASE, n), _powers(_BASE_INVERSE, n)]
    return _UP[0][:n], _UP[1][:n]


class Stretches:
    """Hash of any stretch of 8 bytes or more of a buffer, from prefix sums over mixed 8-byte words."""

    def __init__(self, words: np.ndarray):
        self.up, down = _tables(len(words) + 1)
        self.sums = np.zeros(len(words) + 1, dtype=np.uint64)
        np.cumsum(_mixed(words, _M2) * down[:-1], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[stop - 7] - self.sums[start]) * self.up[start], _M3)


def suffixes(raw: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchored suffixes of the documents ``raw[bounds[i]:bounds[i+1]]``, by segments of bounded size.

    Yields (document, first window, last window, anchor hash, stretch hash, hashes
    of those windows in order) with places counted over ``raw``.
    """
    n = int(bounds[-1])
    if n < LENGTH:
        return
    padded = np.concatenate([raw[:n], np.zeros(8, dtype=np.uint8)])
    for a in range(0, n - LENGTH + 1, SEGMENT):
        b = min(a + SEGMENT, n - LENGTH + 1)
        stop = b + LENGTH - 1
        words = np.ndarray((stop - a,), "<u8", buffer=padded[a:].data, strides=(1,))
        count = stop - a - ANCHOR + 1
        anchor = _mixed(words[:count], _M1)
        for offset in range(8, ANCHOR, 8):
            anchor = _mixed(anchor ^ words[offset : offset + count], _M1)
        order = (_mixed(anchor, _M2) & ~np.uint64((1 << 24) - 1)) | np.arange(count, dtype=np.uint64)
        least, width = order, 1
        while width < WINDOWS:
            step = min(width, WINDOWS - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        starts = np.arange(a, b)
        doc = np.searchsorted(bounds, starts, side="right") - 1
        inside = starts + LENGTH <= bounds[doc + 1]
        starts, doc = starts[inside], doc[inside]
        if not len(starts):
            continue
        at = (least[: b - a][inside] & np.uint64((1 << 24) - 1)).astype(np.int64)
        new = np.ones(len(at), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1
        hashes = Stretches(words[: stop - a])
        lo, hi = starts[first], starts[last]
        whole = hashes.of(lo - a, hi - a + LENGTH)
        shape = ((at[first] + a - lo) * 64 + (hi - lo)).astype(np.uint64)
        windows = hashes.of(starts - a, starts - a + LENGTH)
        yield doc[first], lo, hi, anchor[at[first]], _mixed(whole + shape, _M1), windows


class Block:
    """The documents of a block, sorted by doc_id, with their suffixes."""

    def __init__(self, ids: np.ndarray, raw: np.ndarray, bounds: np.ndarray):
        self.ids, self.raw, self.bounds = ids, raw, bounds
        parts = list(suffixes(raw, bounds))
        names = ("doc", "lo", "hi", "anchor", "stretch", "windows")
        for i, name in enumerate(names):
            kind = np.int64 if i < 3 else np.uint64
            setattr(self, name, np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, dtype=kind))
        sizes = self.hi - self.lo + 1
        self.first_window = np.cumsum(sizes) - sizes
        self.owner = self.ids[self.doc] if len(self.doc) else np.zeros(0, dtype=np.int64)
        order = np.lexsort((self.owner, self.stretch, self.anchor))
        a, s = self.anchor[order], self.stretch[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (a[1:] != a[:-1]) | (s[1:] != s[:-1])
        #: The suffix array of the block: distinct suffixes, and for each occurrence its place there.
        self.sent_anchor, self.sent_stretch = a[new], s[new]
        self.place = np.empty(len(order), dtype=np.int64)
        self.place[order] = np.cumsum(new) - 1
        self.earliest = self.owner[order][new]

    def again(self) -> np.ndarray:
        """Occurrences whose whole stretch an earlier document of the block has."""
        return self.owner > self.earliest[self.place] if len(self.place) else np.zeros(0, dtype=bool)

    def open_windows(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, hash, document id) of the windows that the first scan left open."""
        left = np.flatnonzero((codes[self.place] == 2) & ~self.again()) if len(self.place) else np.zeros(0, dtype=np.int64)
        sizes = (self.hi - self.lo + 1)[left]
        total = int(sizes.sum())
        step = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = np.repeat(self.first_window[left], sizes) + step
        return np.repeat(self.lo[left], sizes) + step, self.windows[at], np.repeat(self.owner[left], sizes)


def _distinct_windows(hashes: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct hashes, the place of each occurrence there, and the least owner of each."""
    order = np.lexsort((owners, hashes))
    h = hashes[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    place = np.empty(len(h), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return h[new], place, owners[order][new]


class Family:
    """A logarithmic family of sorted arrays of suffix keys.

    A batch is merge-scanned against every level, then added as a level; while
    the last two levels have similar sizes they are merged. A key is copied once
    per doubling of the whole.
    """

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def met(self, keys: np.ndarray) -> np.ndarray:
        """Which of the sorted keys a level has."""
        found = np.zeros(len(keys), dtype=bool)
        for level in self.levels:
            at = np.minimum(np.searchsorted(level, keys), len(level) - 1)
            found |= level[at] == keys
        return found

    def add(self, keys: np.ndarray) -> None:
        """Take a sorted batch of keys that no level has."""
        if not len(keys):
            return
        self.levels.append(keys)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            b, a = self.levels.pop(), self.levels.pop()
            merged = np.empty(len(a) + len(b), dtype=a.dtype)
            at = np.searchsorted(a, b) + np.arange(len(b))
            rest = np.ones(len(merged), dtype=bool)
            rest[at] = False
            merged[at], merged[rest] = b, a
            self.levels.append(merged)


SENT = "scan int, block int, bucket int, n int, anchors binary, stretches binary"
_SENT = pa.schema([("scan", pa.int32()), ("block", pa.int32()), ("bucket", pa.int32()), ("n", pa.int32()), ("anchors", pa.binary()), ("stretches", pa.binary())])
CODES = "scan int, block int, bucket int, codes binary"
_CODES = pa.schema([("scan", pa.int32()), ("block", pa.int32()), ("bucket", pa.int32()), ("codes", pa.binary())])


def _cuts(sorted_keys: np.ndarray, buckets: int) -> np.ndarray:
    """Places where sorted 64-bit keys go from one hash range to the next."""
    edges = np.array([(i << 64) // buckets for i in range(1, buckets)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(sorted_keys, edges), [len(sorted_keys)]]).astype(np.int64)


def _low_bytes(x: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _from_low_bytes(raw: bytes, n: int) -> np.ndarray:
    found = np.zeros((len(raw) // n, 8), dtype=np.uint8)
    found[:, :n] = np.frombuffer(raw, dtype=np.uint8).reshape(-1, n)
    return found.view("<u8").reshape(-1).astype(np.uint64)


#: Bytes sent of an anchor hash and of a stretch hash; the hash range of the bucket comes on top.
ANCHOR_BYTES, STRETCH_BYTES = 5, 6


def _load(table: pa.Table) -> Block:
    """A block from its rows: doc_id and text, by doc_id and text, so that all passes see one layout."""
    ids = np.array([LAST if d is None else d for d in table.column("doc_id").to_pylist()], dtype=np.int64)
    texts = table.column("text").combine_chunks().cast(pa.large_binary())
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.large_binary())
    order = np.argsort(ids, kind="stable")
    texts = texts.fill_null(b"")
    for rows in np.split(order, np.flatnonzero(np.diff(ids[order])) + 1):
        if len(rows) > 1:
            rows[:] = sorted(rows.tolist(), key=lambda i: texts[i].as_py())
    texts = texts.take(pa.array(order))
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data is not None and len(order) else np.zeros(0, dtype=np.uint8)
    return Block(ids[order], raw, (offsets - offsets[0]).astype(np.int64) if len(order) else np.zeros(1, dtype=np.int64))


def _sends(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        block, number = _load(table), table.column("block")[0].as_py()
        cuts = _cuts(block.sent_anchor, buckets)
        rows = [
            (1, number, k, int(b - a), _low_bytes(block.sent_anchor[a:b], ANCHOR_BYTES), _low_bytes(block.sent_stretch[a:b], STRETCH_BYTES))
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a
        ]
        return _table(rows, _SENT)

    return run


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _scan_suffixes(table: pa.Table) -> pa.Table:
    """Codes of the suffixes of one hash range: 1 met in an earlier block, 2 anchor met with other text, 0 neither."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("block", "bucket", "anchors", "stretches"))))
    family = Family()
    sent = []
    for _, _, anchors, stretches in rows:
        # One key of 64 bits orders a suffix: the anchor's low bytes mixed with the stretch.
        a, s = _from_low_bytes(anchors, ANCHOR_BYTES), _from_low_bytes(stretches, STRETCH_BYTES)
        sent.append((a, _mixed(a * _M1 + s, _M2)))
    met = []
    for a, keys in sent:
        order = np.argsort(keys)
        found = np.empty(len(keys), dtype=bool)
        found[order] = family.met(keys[order])
        family.add(keys[order][~found[order]])
        met.append(found)
    # An anchor is shared when suffixes that differ, sent by any blocks, begin with it.
    fresh = np.concatenate([a[~m] for (a, _), m in zip(sent, met)])
    fresh.sort()
    shared = np.unique(fresh[1:][fresh[1:] == fresh[:-1]])
    out = []
    for (number, bucket, _, _), (a, _), found in zip(rows, sent, met):
        codes = np.where(found, 1, 0).astype(np.uint8)
        if len(shared):
            at = np.minimum(np.searchsorted(shared, a), len(shared) - 1)
            codes[~found & (shared[at] == a)] = 2
        out.append((1, number, bucket, codes.tobytes()))
    return _table(out, _CODES)


def _scan_windows(table: pa.Table) -> pa.Table:
    """Codes of the windows of one hash range: 1 met in an earlier block."""
    rows = sorted(zip(*(table.column(c).to_pylist() for c in ("block", "bucket", "anchors"))))
    family, out = Family(), []
    for number, bucket, hashes in rows:
        keys = np.frombuffer(hashes, dtype="<u8")
        found = family.met(keys)
        family.add(keys[~found])
        out.append((2, number, bucket, found.astype(np.uint8).tobytes()))
    return _table(out, _CODES)


def _codes(replies: pa.Table, scan: int, cuts: np.ndarray) -> np.ndarray:
    """Codes of all that a block sent in a scan, in the order sent."""
    codes = np.zeros(int(cuts[-1]), dtype=np.uint8)
    for which, bucket, raw in zip(*(replies.column(c).to_pylist() for c in ("scan", "bucket", "codes"))):
        if which == scan:
            codes[cuts[bucket] : cuts[bucket + 1]] = np.frombuffer(raw, dtype=np.uint8)
    return codes


def _asks(buckets: int):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _table([], _SENT)
        block, number = _load(docs), docs.column("block")[0].as_py()
        codes = _codes(replies, 1, _cuts(block.sent_anchor, buckets))
        _, hashes, owners = block.open_windows(codes)
        keys, _, _ = _distinct_windows(hashes, owners)
        cuts = _cuts(keys, buckets)
        rows = [(2, number, k, int(b - a), keys[a:b].astype("<u8").tobytes(), b"") for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]
        return _table(rows, _SENT)

    return run


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def removed_bytes(block: Block, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Mask of the block's bytes that go, from the codes of both scans."""
    edge = np.zeros(len(block.raw) + LENGTH + 1, dtype=np.int32)
    if len(block.place):
        gone = block.again() | (first[block.place] == 1)
        np.add.at(edge, block.lo[gone], 1)
        np.add.at(edge, block.hi[gone] + LENGTH, -1)
        starts, hashes, owners = block.open_windows(first)
        _, place, least = _distinct_windows(hashes, owners)
        if len(starts):
            hit = (second[place] == 1) | (owners > least[place])
            np.add.at(edge, starts[hit], 1)
            np.add.at(edge, starts[hit] + LENGTH, -1)
    return np.cumsum(edge)[: len(block.raw)] > 0


def _cleans(buckets: int, with_text: bool):
    def run(docs: pa.Table, replies: pa.Table) -> pa.Table:
        schema = _RESULT.append(pa.field("kept", pa.binary())) if with_text else _RESULT
        if not docs.num_rows:
            return _table([], schema)
        block = _load(docs)
        first = _codes(replies, 1, _cuts(block.sent_anchor, buckets))
        _, hashes, owners = block.open_windows(first)
        keys, _, _ = _distinct_windows(hashes, owners)
        gone = removed_bytes(block, first, _codes(replies, 2, _cuts(keys, buckets)))
        rows = []
        for i, ident in enumerate(block.ids.tolist()):
            a, b = int(block.bounds[i]), int(block.bounds[i + 1])
            part = gone[a:b]
            spans = int(part[0]) + int((part[1:] & ~part[:-1]).sum()) if b > a else 0
            kept = block.raw[a:b][~part].tobytes()
            row = (None if ident == LAST else ident, b - a, int(part.sum()), spans, hashlib.sha256(kept).hexdigest())
            rows.append(row + ((kept,) if with_text else ()))
        return _table(rows, schema)

    return run


def _blocks(documents: DataFrame, block_bytes: int) -> tuple[DataFrame, int]:
    """Documents with the number of their block: ranges of doc_id of about equal row counts, and all bytes.

    The bounds are literals, so a block is the same rows in every pass.
    """
    rows, size = documents.agg(F.count("doc_id"), F.sum(F.octet_length("text"))).first()
    size = int(size or 0)
    count = min(task_count(documents.sparkSession, size, block_bytes), max(1, rows))
    cuts: list[int] = []
    if count > 1:
        shares = [i / count for i in range(1, count)]
        cuts = sorted(set(documents.agg(F.percentile_approx("doc_id", shares, 20 * count)).first()[0]))
    edges = np.array(cuts, dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = np.array([LAST if d is None else d for d in batch.column(0).to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.searchsorted(edges, ids, side="left").astype(np.int32)), batch.column(0), batch.column(1).cast(pa.string())],
                names=["block", "doc_id", "text"],
            )

    picked = documents.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    placed = picked.mapInArrow(place, "block int, doc_id bigint, text string")
    return placed.repartition(len(edges) + 1, "block"), size


def remove_repeats(documents: DataFrame, block_bytes: int = BLOCK_BYTES, bucket_bytes: int = BUCKET_BYTES, with_text: bool = False) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and ``kept``, the remaining bytes).

    Texts are shuffled once; that exchange feeds all three passes. Everything else
    that moves is a hash per distinct suffix and block, and a code in return.
    """
    placed, size = _blocks(documents, block_bytes)
    buckets = task_count(documents.sparkSession, size * (ANCHOR_BYTES + STRETCH_BYTES) // 13, bucket_bytes)
    sent = placed.groupBy("block").applyInArrow(_sends(buckets), SENT)
    first = sent.groupBy("bucket").applyInArrow(_scan_suffixes, CODES)
    asked = placed.groupBy("block").cogroup(first.groupBy("block")).applyInArrow(_asks(buckets), SENT)
    second = asked.groupBy("bucket").applyInArrow(_scan_windows, CODES)
    replies = first.unionByName(second)
    result = RESULT + (", kept binary" if with_text else "")
    return placed.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_cleans(buckets, with_text), result)
