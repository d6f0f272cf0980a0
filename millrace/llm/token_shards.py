"""Token ids in binary shards, each a wavelet matrix.

A shard holds the ids of a run of documents in ascending doc_id order. Its ids
are cut into bit planes, most significant first; from plane to plane the ids are
stably parted by the bit. Each plane keeps the number of its ones before every
block, so that any id, the count of an id in a stretch, and the place of its k-th
occurrence are found by a step per plane, without unpacking the shard.

Shards are rows of a Parquet table (zstd), written and read by Spark: (part,
shard, n_docs, n_tokens, content). ``content`` is the file format; it needs nothing
but itself to be read.

Defined cases: a null or empty text is a document of the end id alone; rows with
equal doc_id are separate documents, ordered by text; a null doc_id comes first
and stays null; an empty table writes no shard; a text longer than a shard is a
shard of its own; extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections import deque
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import arrow_rows
from millrace.session import scratch_path

SHARD_TOKENS = 1 << 20
MEMO_ENTRIES = 700_000
BATCH_ROWS = 1000
CHUNK_CHARS = 4 << 20
MAGIC = b"WMX1"
BLOCK_BYTES = 64

_BITS_SET = np.array([bin(b).count("1") for b in range(256)], dtype=np.uint8)
# How a byte-level vocabulary writes bytes: printable ones as they are, the others from 256 on, in order.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SPELLED = np.arange(256, dtype="<u2")
_SPELLED[[b for b in range(256) if b not in _PLAIN]] = np.arange(256, 512 - len(_PLAIN))
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_SPACE = re.compile(r"[\s\u180e\u200b-\u200f\ufeff]")
# A space between two white-space characters is the one kind that no piece starts or ends at.
_SPACED = re.compile(r" [\s\u180e\u200b-\u200f\ufeff]")
_INNER_SPACE = re.compile(r"[\s\u180e\u200b-\u200f\ufeff] [\s\u180e\u200b-\u200f\ufeff]")
# Commas and stops that are no piece of their own, or may not be, and line ends likewise.
_ODD_SIGNS = r"[^A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}][,.][ \n]|\.\n(?:[^A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]|\z)"


class WaveletMatrix:
    """Ids with access, rank and select on bit planes."""

    def __init__(self, n: int, zeros: np.ndarray, planes: np.ndarray, ranks: np.ndarray):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def of(cls, ids: np.ndarray) -> WaveletMatrix:
        """Build from ids."""
        n = len(ids)
        depth = max(1, int(ids.max()).bit_length()) if n else 1
        x = ids.astype(np.uint16 if depth <= 16 else np.uint32)
        width = -(-n // (8 * BLOCK_BYTES)) * BLOCK_BYTES
        planes = np.zeros((depth, width), dtype=np.uint8)
        zeros = np.zeros(depth, dtype=np.uint64)
        for level in range(depth):
            ones = (x & x.dtype.type(1 << (depth - 1 - level))) != 0
            packed = np.packbits(ones, bitorder="little")
            planes[level, : len(packed)] = packed
            high = np.flatnonzero(ones)
            zeros[level] = n - len(high)
            parted = np.empty_like(x)
            np.compress(~ones, x, out=parted[: n - len(high)])
            np.take(x, high, out=parted[n - len(high) :])
            x = parted
        return cls(n, zeros, planes, cls._ranks(planes))

    @staticmethod
    def _ranks(planes: np.ndarray) -> np.ndarray:
        """Ones before each block of every plane."""
        blocks = planes.shape[1] // BLOCK_BYTES
        ranks = np.zeros((planes.shape[0], blocks + 1), dtype=np.uint64)
        for level in range(planes.shape[0]):
            ones = _BITS_SET[planes[level]].reshape(blocks, BLOCK_BYTES).sum(axis=1, dtype=np.uint64)
            ranks[level, 1:] = np.cumsum(ones)
        return ranks

    def _ones(self, level: int, at: int) -> int:
        """Ones of a plane before ``at``."""
        block, byte = at // (8 * BLOCK_BYTES), at // 8
        plane = self.planes[level]
        count = int(self.ranks[level, block]) + int(_BITS_SET[plane[block * BLOCK_BYTES : byte]].sum(dtype=np.int64))
        if at % 8:
            count += bin(int(plane[byte]) & ((1 << at % 8) - 1)).count("1")
        return count

    def access(self, at: int) -> int:
        """The id at a place."""
        if not 0 <= at < self.n:
            raise IndexError(at)
        found = 0
        for level in range(len(self.planes)):
            bit = int(self.planes[level, at // 8]) >> at % 8 & 1
            ones = self._ones(level, at)
            at = int(self.zeros[level]) + ones if bit else at - ones
            found = found << 1 | bit
        return found

    def rank(self, wanted: int, stop: int, start: int = 0) -> int:
        """How often an id occurs in [start, stop)."""
        depth = len(self.planes)
        if wanted >> depth:
            return 0
        for level in range(depth):
            a, b = self._ones(level, start), self._ones(level, stop)
            if wanted >> (depth - 1 - level) & 1:
                start, stop = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                start, stop = start - a, stop - b
        return stop - start

    def select(self, wanted: int, k: int) -> int:
        """Place of the k-th occurrence (from 0) of an id, or -1."""
        depth = len(self.planes)
        if k < 0 or k >= self.rank(wanted, self.n):
            return -1
        at = 0
        for level in range(depth):
            ones = self._ones(level, at)
            at = int(self.zeros[level]) + ones if wanted >> (depth - 1 - level) & 1 else at - ones
        at += k
        for level in reversed(range(depth)):
            bit = wanted >> (depth - 1 - level) & 1
            at = self._find(level, at - int(self.zeros[level]) if bit else at, bit)
        return at

    def _find(self, level: int, k: int, bit: int) -> int:
        """Place of the k-th bit of a kind on a plane."""
        before = self.ranks[level].astype(np.int64)
        if not bit:
            before = np.arange(len(before)) * 8 * BLOCK_BYTES - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        bits = np.unpackbits(self.planes[level, block * BLOCK_BYTES : (block + 1) * BLOCK_BYTES], bitorder="little")
        return block * 8 * BLOCK_BYTES + int(np.flatnonzero(bits == bit)[k - int(before[block])])

    def decode(self) -> np.ndarray:
        """All ids, by undoing the parting from the last plane to the first."""
        depth = len(self.planes)
        x = np.zeros(self.n, dtype=np.uint16 if depth <= 16 else np.uint32)
        for level in reversed(range(depth)):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            before = np.empty_like(x)
            low = int(self.zeros[level])
            before[np.flatnonzero(~ones)] = x[:low]
            before[np.flatnonzero(ones)] = x[low:] | x.dtype.type(1 << (depth - 1 - level))
            x = before
        return x

    def to_bytes(self) -> bytes:
        """Header, ones before blocks, planes."""
        depth, width = self.planes.shape
        head = struct.pack("<QIQ", self.n, depth, width) + self.zeros.astype("<u8").tobytes()
        return head + self.ranks.astype("<u8").tobytes() + self.planes.tobytes()

    @classmethod
    def from_bytes(cls, raw: memoryview) -> WaveletMatrix:
        n, depth, width = struct.unpack_from("<QIQ", raw)
        at = struct.calcsize("<QIQ")
        zeros = np.frombuffer(raw, "<u8", depth, at)
        at += 8 * depth
        blocks = width // BLOCK_BYTES + 1
        ranks = np.frombuffer(raw, "<u8", depth * blocks, at).reshape(depth, blocks)
        at += 8 * depth * blocks
        return cls(n, zeros, np.frombuffer(raw, np.uint8, depth * width, at).reshape(depth, width), ranks)


def pack_shard(doc_ids: Sequence[int | None], lengths: Sequence[int], ids: np.ndarray) -> bytes:
    """A shard's file: the documents (id, null mark, number of ids) and the matrix."""
    nulls = np.array([d is None for d in doc_ids], dtype=np.uint8)
    named = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
    head = MAGIC + struct.pack("<Q", len(named)) + named.tobytes() + nulls.tobytes()
    return head + np.asarray(lengths, dtype="<u8").tobytes() + WaveletMatrix.of(ids).to_bytes()


def open_shard(raw: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Documents, their numbers of ids, and the matrix of a shard's file."""
    view = memoryview(raw)
    if bytes(view[:4]) != MAGIC:
        raise ValueError("not a token shard")
    (n,) = struct.unpack_from("<Q", view, 4)
    named = np.frombuffer(view, "<i8", n, 12).tolist()
    nulls = np.frombuffer(view, np.uint8, n, 12 + 8 * n)
    lengths = np.frombuffer(view, "<u8", n, 12 + 9 * n).astype(np.int64)
    return [None if x else d for d, x in zip(named, nulls)], lengths, WaveletMatrix.from_bytes(view[12 + 17 * n :])


class Encoder:
    """The tokenizer, with its results for single words remembered.

    A byte-level tokenizer cuts a text before every space that a word follows and
    after every word that a space follows, so what stands between two spaces is
    encoded on its own, with the space before it. Commas and stops after a word are
    words of their own. Arrow cuts some texts at a time and numbers their words after
    those remembered, so only distinct words not met before are seen one by one. Those
    that are letters, or letters and signs after them, fall into pieces that are known
    beforehand and go straight to the tokenizer's model, all in one call. The others are
    encoded together, as one text. Ids are told apart by the bytes they stand for. Texts
    with a space inside other white space are encoded whole. When more words than
    ``entries`` are remembered, the half of them that was met most often stays.
    """

    def __init__(self, path: str, entries: int = MEMO_ENTRIES):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: The model alone, for pieces that are cut and spelled already.
        self.merges = Tokenizer(self.tokenizer.model)
        self.entries = entries
        vocabulary = self.tokenizer.get_vocab()
        self.kind = "<u2" if len(vocabulary) <= 1 << 16 else "<u4"
        #: Bytes of text that an id stands for.
        self.widths = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, ident in vocabulary.items():
            self.widths[ident] = len(token)
        #: Words remembered, their ids, and how often they were met.
        self.words = pa.array([], pa.string())
        self.ids = _lists(np.zeros(0, self.kind), np.zeros(0, np.int64))
        self.uses = np.zeros(0, dtype=np.int64)

    def _ids(self, text: str) -> np.ndarray:
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, dtype=self.kind)

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of the whole text."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Ids of every whole text, in order; words are looked up for some texts at a time."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text or "")
            size += len(held[-1])
            if size >= CHUNK_CHARS:
                yield from self._encode_some(held)
                held, size = [], 0
        yield from self._encode_some(held)

    def _encode_some(self, texts: list[str]) -> Iterator[np.ndarray]:
        whole = ["\0" in t or bool(_SPACED.search(t) and _INNER_SPACE.search(t)) for t in texts]
        flat, stops = _cut([t for t, w in zip(texts, whole) if not w])
        ids = self._words(flat)
        ends = iter(ids.offsets.to_numpy()[stops].tolist())
        flat = ids.values.to_numpy()
        start = 0
        for text, alone in zip(texts, whole):
            if alone:
                yield self._ids(text)
            else:
                stop = next(ends)
                yield flat[start:stop]
                start = stop

    def _words(self, words: pa.Array) -> pa.ListArray:
        """Ids of every word."""
        coded = pa.concat_arrays([self.words, words]).dictionary_encode()
        at = coded.indices.slice(len(self.words))
        new = coded.dictionary.slice(len(self.words))
        if len(new):
            self.ids = pa.concat_arrays([self.ids, self._learn(new.to_pylist())])
            self.words = coded.dictionary
        found = self.ids.take(at)
        uses = np.bincount(at.to_numpy(), minlength=len(self.words))
        uses[: len(self.uses)] += self.uses
        self.uses = uses
        if len(uses) > self.entries:
            # Of words met equally often the later ones stay.
            kept = np.sort(np.argsort(uses, kind="stable")[len(uses) - self.entries // 2 :])
            self.words, self.ids, self.uses = self.words.take(pa.array(kept)), self.ids.take(pa.array(kept)), uses[kept] // 2
        return found

    def _learn(self, new: list[str]) -> pa.ListArray:
        """Ids of distinct words, from the tokenizer."""
        #: Pieces to encode, with their numbers. A piece without a space before it has the mark.
        pieces: dict[str, int] = {}
        #: Numbers of the pieces of every word, and how many of them a word has; words of no pieces.
        order: list[int] = []
        counts = np.ones(len(new), dtype=np.int64)
        rest: list[int] = []
        for i, word in enumerate(new):
            if not word.isalpha():
                stem = word.rstrip(_SIGNS)
                if not (stem[1:] if stem[:1] == "\0" else stem).isalpha():
                    rest.append(i)
                    order.append(-len(rest))
                    continue
                if len(stem) < len(word):
                    order.append(pieces.setdefault(stem, len(pieces)))
                    word = "\0" + word[len(stem) :]
                    counts[i] = 2
            order.append(pieces.setdefault(word, len(pieces)))
        parts = pa.concat_arrays([self._pieces(list(pieces)), self._others([new[i] for i in reversed(rest)])])
        at = np.array(order, dtype=np.int64)
        parts = parts.take(pa.array(np.where(at < 0, at + len(parts), at)))
        return pa.ListArray.from_arrays(parts.offsets.take(pa.array(np.append(0, np.cumsum(counts)))), parts.values)

    def _pieces(self, pieces: list[str]) -> pa.ListArray:
        """A piece's bytes, as the vocabulary writes them, go to the merges."""
        if not pieces:
            return _lists(np.zeros(0, self.kind), np.zeros(0, np.int64))
        spelled = _spelled(pieces)
        found = self.merges.encode_batch_fast([spelled], is_pretokenized=True, add_special_tokens=False)[0].ids
        ids = self._apart(np.array(found, dtype=self.kind), np.fromiter(map(len, spelled), np.int64, len(spelled)))
        if ids is None:
            raise ValueError("the vocabulary does not spell every byte")
        return ids

    def _others(self, words: list[str]) -> pa.ListArray:
        """Words that are no pieces: those that may stand behind a space as one text, the others on their own."""
        joint = [i for i, w in enumerate(words) if w and w[0] != "\0" and not _SPACE.match(w)]
        found: list[np.ndarray | None] = [None] * len(words)
        if joint:
            text = " " + " ".join(words[i] for i in joint)
            ids = self._apart(self._ids(text), np.array([len(words[i].encode()) + 1 for i in joint]))
            for i, x in zip(joint, [] if ids is None else np.split(ids.values.to_numpy(), ids.offsets.to_numpy()[1:-1])):
                found[i] = x
        for i, word in enumerate(words):
            if found[i] is None:
                found[i] = self._ids(word[1:] if word[:1] == "\0" else " " + word)
        return _lists(np.concatenate([np.zeros(0, self.kind), *found]), np.array([len(x) for x in found], dtype=np.int64))

    def _apart(self, ids: np.ndarray, lengths: np.ndarray) -> pa.ListArray | None:
        """Ids of words that stand one after the other, told apart by their bytes; None if a token goes across."""
        ends, stops = np.cumsum(self.widths[ids]), np.cumsum(lengths)
        cuts = np.minimum(np.searchsorted(ends, stops), len(ends) - 1)
        return _lists(ids, np.diff(cuts, prepend=-1)) if (ends[cuts] == stops).all() else None


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """Lists that stand one after the other."""
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(flat))


def _cut(texts: list[str]) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, and where each text's words end. The first has no space before it; the mark keeps it apart."""
    rows = pa.array(["\0" + t for t in texts], pa.string())
    split = pc.split_pattern(pc.if_else(pc.match_substring_regex(rows, _ODD_SIGNS), rows, _signs_apart(rows)), " ")
    return split.flatten(), split.offsets.to_numpy()[1:]


def _signs_apart(rows: pa.Array) -> pa.Array:
    """Commas and stops after a word, and line ends after a stop, as words of their own, with the mark."""
    for found, apart in ((", ", " \0, "), (". ", " \0. "), (".\n", " \0. \0\n \0")):
        rows = pc.replace_substring(rows, found, apart)
    return rows


def _spelled(pieces: list[str]) -> list[str]:
    """The pieces' bytes as the vocabulary writes them, with the space before those that have no mark.

    No piece holds a line end, so all are written as one text of lines.
    """
    lines = "\n".join([p[1:] if p[0] == "\0" else " " + p for p in pieces])
    return _SPELLED[np.frombuffer(lines.encode(), np.uint8)].tobytes().decode("utf-16-le").split(chr(_SPELLED[10]))


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """One per Python worker, kept between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


SHARDS = "part int, shard int, n_docs bigint, n_tokens bigint, content binary"


def write_shards(
    documents: DataFrame, path: str, tokenizer: str, end_id: int = 0, shard_tokens: int = SHARD_TOKENS, parts: int | None = None
) -> None:
    """Encode every document, append ``end_id`` and write shards in ascending doc_id order.

    Documents are shuffled once, into ranges of doc_id; a task sorts its range
    and closes a shard when it holds ``shard_tokens`` ids. The ids of one shard, and
    the texts that are encoded together (a batch and ``CHUNK_CHARS``), are all that a task holds.
    """
    spark = documents.sparkSession
    names = [part.split()[0] for part in SHARDS.split(", ")]

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = _encoder(tokenizer), TaskContext.get().partitionId()
        held: list[np.ndarray] = []
        docs: list[int | None] = []
        size = number = 0

        def closed() -> pa.RecordBatch:
            ids = np.concatenate(held)
            row = [part], [number], [len(docs)], [len(ids)], [pack_shard(docs, [len(x) for x in held], ids)]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds)], names=names)

        waiting: deque[int | None] = deque()

        def texts() -> Iterator[str | None]:
            for batch in batches:
                waiting.extend(batch.column(0).to_pylist())
                yield from batch.column(1).to_pylist()

        for ids in encoder.encode_all(texts()):
            held.append(np.append(ids, ids.dtype.type(end_id)))
            docs.append(waiting.popleft())
            size += len(held[-1])
            if size >= shard_tokens:
                yield closed()
                held, docs, size, number = [], [], 0, number + 1
        if docs:
            yield closed()

    count = parts or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    ranged = documents.select("doc_id", "text").repartitionByRange(count, "doc_id").sortWithinPartitions("doc_id", "text")
    with arrow_rows(spark, BATCH_ROWS):
        ranged.mapInArrow(shards, SHARDS).write.option("compression", "zstd").parquet(path)


TOKENS = "part int, shard int, doc_id bigint, local bigint, n_tokens bigint, ids_crc32 bigint"


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Documents as the shards hold them: (doc_id, start, n_tokens, ids_crc32).

    ``start`` is the number of ids of all documents before. Totals are summed per
    range, then over ranges; ids stay in the task that unpacks their shard.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    names = [part.split()[0] for part in TOKENS.split(", ")]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, shard, content in zip(*(c for c in batch.columns)):
                docs, lengths, matrix = open_shard(content.as_py())
                ids = matrix.decode().astype("<u4")
                stops = np.cumsum(lengths)
                starts = stops - lengths
                sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), stops.tolist())]
                n = len(docs)
                rows = [part.as_py()] * n, [shard.as_py()] * n, docs, starts, lengths, sums
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows, kinds)], names=names)

    docs = shards.select("part", "shard", "content").mapInArrow(unpack, TOKENS)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes = shards.select("part", "shard", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_part"))
    starts = sizes.withColumn("_shard", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).drop("n_tokens").join(parts, "part")
    start = F.col("local") + F.col("_part") + F.col("_shard")
    return docs.join(starts, ["part", "shard"]).select("doc_id", start.alias("start"), "n_tokens", "ids_crc32")


def look_up(spark: SparkSession, path: str, token: int) -> DataFrame:
    """How often a token occurs in each shard, and its first place there (-1: none), read from the planes."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, shard, content = (c.to_pylist() for c in batch.columns)
            matrices = [open_shard(raw)[2] for raw in content]
            found = [part, shard, [m.rank(token, m.n) for m in matrices], [m.select(token, 0) for m in matrices]]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found, kinds)], names=["part", "shard", "n", "first"])

    shards = spark.read.schema(SHARDS).parquet(path).select("part", "shard", "content")
    return shards.mapInArrow(counts, "part int, shard int, n bigint, first bigint")


def tokenise(documents: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Write shards to the shared folder and read them back."""
    path = scratch_path(documents.sparkSession, "tokens")
    write_shards(documents, path, tokenizer, **options)
    return read_shards(documents.sparkSession, path)
