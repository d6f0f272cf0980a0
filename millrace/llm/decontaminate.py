"""Benchmark decontamination by pigeonhole edit matching.

A test item of n characters may be met with e = floor(rate * n) edits. Cut into
e + 1 pieces, at least one piece of any such occurrence is untouched. All pieces
of all items go into one Aho-Corasick automaton; each exact piece hit names a
stretch of the text, which Myers' bit-parallel algorithm verifies.

Texts and items are compared in lower case with single spaces. Offsets are in
that form of the text.

Defined cases: a null, empty or blank text or item matches nothing; an item
found several times in a document is reported once, at its least distance and
then its earliest end; equal items with different ids are all reported, items
without an id with a null item_id; rows with repeated or null doc_id are matched like others; an empty table gives no rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RATE = 0.05
#: Bytes of items put into one automaton; a larger benchmark is matched in several rounds.
ROUND_BYTES = 4 << 20


def normalise(text: str | None) -> str:
    """Lower case, one space for white space, trimmed."""
    return " ".join(text.lower().split()) if text else ""


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """``errors + 1`` pieces of almost equal length with their offsets."""
    n = min(errors + 1, len(item))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def masks(pattern: str) -> dict[str, int]:
    """Bit i of a character's mask says that the pattern has it at i."""
    found: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        found[c] |= 1 << i
    return dict(found)


def best_end(peq: dict[str, int], m: int, text: str) -> tuple[int, int]:
    """Least edit distance of the pattern to any stretch of the text, and the first end where it is met."""
    every, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, at = every, 0, m, m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (~(xh | pv) & every)
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & every, (mh << 1) & every
        pv = mh | (~(xv | ph) & every)
        mv = ph & xv
        if score < best:
            best, at = score, j
    return best, at


class Matcher:
    """The items of one round, ready to be searched for."""

    def __init__(self, items: Sequence[tuple[int, str]], rate: float):
        self.items = [(i, t, int(rate * len(t))) for i, t in items if t]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, text, errors) in enumerate(self.items):
            for offset, piece in pieces(text, errors):
                places[piece].append((k, offset))
        self.places = [(len(p), where) for p, where in places.items()]
        self.automaton = ahocorasick.Automaton()
        for n, piece in enumerate(places):
            self.automaton.add_word(piece, n)
        self.automaton.make_automaton()
        self.ready: dict[int, tuple[dict[str, int], dict[str, int]]] = {}

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item id, distance, start, stop) of every item that the text holds."""
        if not text or not self.items:
            return []
        near: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for end, n in self.automaton.iter(text):
            length, where = self.places[n]
            for k, offset in where:
                _, item, errors = self.items[k]
                start = end + 1 - length - offset
                near[k].append((max(0, start - errors), min(len(text), start + len(item) + errors)))
        found = []
        for k, stretches in near.items():
            ident, item, errors = self.items[k]
            best = None
            # Stretches that overlap are read once, so a piece met all over a text costs one pass.
            stretches.sort()
            merged: list[list[int]] = []
            for a, b in stretches:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], b)
                else:
                    merged.append([a, b])
            for a, b in merged:
                at = text.find(item, a, b)
                if at >= 0:
                    if best is None or best[0]:
                        best = (0, at, at + len(item))
                    break
                if b - a < len(item) - errors:
                    continue
                if k not in self.ready:
                    self.ready[k] = (masks(item), masks(item[::-1]))
                forward, backward = self.ready[k]
                distance, stop = best_end(forward, len(item), text[a:b])
                if distance <= errors and (best is None or distance < best[0]):
                    tail = text[max(a, a + stop - len(item) - errors) : a + stop]
                    _, back = best_end(backward, len(item), tail[::-1])
                    best = (distance, a + stop - back, a + stop)
            if best is not None:
                found.append((ident, *best))
        return found


def _rounds(benchmark: DataFrame, limit: int) -> list[list[tuple[int | None, str]]]:
    """The items in rounds of at most ``limit`` bytes each (or one longer item)."""
    items = benchmark.filter("text is not null").select("item_id", "text").distinct()
    found: list[list[tuple[int | None, str]]] = [[]]
    size = 0
    for row in items.orderBy(F.asc_nulls_first("item_id"), "text").toLocalIterator():
        text = normalise(row["text"])
        if size and size + 4 * len(text) > limit:
            found.append([])
            size = 0
        found[-1].append((row["item_id"], text))
        size += 4 * len(text)
    return found


MATCHES = "array<struct<item_id:bigint,distance:bigint,start:bigint,stop:bigint>>"


def with_matches(documents: DataFrame, benchmark: DataFrame, rate: float = RATE, into: str = "matches") -> DataFrame:
    """All columns of the documents and the items found in each.

    The documents are not shuffled. Each round's items go to the tasks as a
    constant of at most ``ROUND_BYTES``; a benchmark beyond that is matched in as
    many rounds as it needs, over the same scan, so it never has to be small.
    """
    parts = [_finder(items, rate)(F.col("text")) for items in _rounds(benchmark, ROUND_BYTES)]
    return documents.withColumn(into, parts[0] if len(parts) == 1 else F.concat(*parts))


def _finder(items: list[tuple[int, str]], rate: float):
    holder: list[Matcher] = []

    @F.pandas_udf(MATCHES)
    def find(texts: pd.Series) -> pd.Series:
        if not holder:
            holder.append(Matcher(items, rate))
        names = ("item_id", "distance", "start", "stop")
        return pd.Series([[dict(zip(names, m)) for m in holder[0].find(normalise(t))] for t in texts], dtype=object)

    return find


def leaks(documents: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """A row per document and item it holds: (doc_id, item_id, distance, start, stop)."""
    found = with_matches(documents.select("doc_id", "text"), benchmark, rate).select("doc_id", F.explode("matches").alias("m"))
    return found.select("doc_id", "m.item_id", "m.distance", "m.start", "m.stop")
