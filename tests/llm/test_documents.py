"""Document operators against plain versions, on odd rows and on the smallest tables."""

import hashlib
import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
from millrace.llm import common, decontaminate, licences, mixing, near_dedup, suffix_dedup, token_shards
from millrace.llm.common import components, words_of
from millrace.llm.queries import byte_tokenizer

SF = "/root/testdata/sf0.001"
NAMES = ["doc_id", "text", "source"]


def plain(df):
    return [tuple(r) for r in df.select(*NAMES).collect()]


@pytest.fixture(scope="module", params=["odd", "sf"])
def documents(request, spark, odd):
    return odd if request.param == "odd" else spark.read.parquet(f"{SF}/documents.parquet")


# --- suffix arrays -------------------------------------------------------------------


def plain_removal(rows):
    met, found = {}, []
    for ident, text, _ in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - 49):
            met[raw[i : i + 50]] = min(met.get(raw[i : i + 50], math.inf), math.inf if ident is None else ident)
    for ident, text, _ in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - 49):
            if met[raw[i : i + 50]] < (math.inf if ident is None else ident):
                gone[i : i + 50] = True
        spans = sum(1 for i in range(len(raw)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        found.append((ident, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(found, key=repr)


def test_repeats_are_removed(documents):
    got = suffix_dedup.remove_repeats(documents, block_bytes=40_000, bucket_bytes=20_000)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_removal(plain(documents))


def test_kept_bytes(spark, odd):
    for row in suffix_dedup.remove_repeats(odd, with_text=True).collect():
        assert hashlib.sha256(bytes(row.kept)).hexdigest() == row.kept_sha256 and len(row.kept) == row.n_bytes - row.n_removed


def test_family_is_logarithmic():
    family, r = suffix_dedup.Family(), np.random.default_rng(1)
    known = set()
    for _ in range(200):
        keys = np.unique(r.integers(0, 5000, 30).astype(np.uint64))
        found = family.met(keys)
        assert found.tolist() == [int(k) in known for k in keys]
        family.add(keys[~found])
        known |= set(map(int, keys))
        assert len(family.levels) <= 2 + math.log2(len(known))
    assert all((np.diff(level.astype(np.int64)) > 0).all() for level in family.levels)


def test_segments_do_not_change_the_result(monkeypatch):
    r = np.random.default_rng(3)
    raw = r.integers(97, 100, 5000).astype(np.uint8)
    bounds = np.array([0, 10, 1500, 1549, 1599, 5000])
    whole = [np.concatenate(p) for p in zip(*suffix_dedup.suffixes(raw, bounds))]
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 97)
    cut = [np.concatenate(p) for p in zip(*suffix_dedup.suffixes(raw, bounds))]
    assert (whole[5] == cut[5]).all()


# --- mix -----------------------------------------------------------------------------


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level >= cap * sizes[s]}
        for s in full:
            target[s] = float(cap * sizes[s])
            left -= target[s]
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        open_ -= full
    return target


def test_mix(documents):
    rows = [tuple(r) for r in mixing.mix(documents, keep=["source"]).collect()]
    sizes = Counter()
    for _, text, source in plain(documents):
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    targets = plain_targets(sizes)
    taken = Counter()
    for ident, size, source_size, target, words, source in rows:
        assert source_size == sizes[source] and target == pytest.approx(targets[source]) and 0 <= words <= 2 * size
        taken[source] += words
    assert len(rows) == documents.count()
    assert all(taken[s] == math.floor(targets[s] + 1e-9) for s in sizes)
    again = sorted(map(tuple, mixing.mix(documents, keep=["source"]).collect()), key=repr)
    assert again == sorted(rows, key=repr)


def test_hot_source_is_summed_by_slices(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 10)
    rows = spark.range(500).selectExpr("id doc_id", "repeat('w ', cast(id % 7 as int)) text", "if(id % 3 = 0, 'hot', concat('s', id % 9)) source")
    got = mixing.mix(rows, share=0.7, keep=["source"]).groupBy("source").sum("taken", "target").collect()
    for row in got:
        n = rows.filter(rows.source == row.source).count()
        assert row["sum(taken)"] == math.floor(row["sum(target)"] / n + 1e-6)


def test_mixed_documents_hold_the_words_taken(odd):
    named = odd.filter("doc_id is not null").dropDuplicates(["doc_id"])
    taken = {r.doc_id: r.taken for r in mixing.mix(named).collect()}
    mixed = mixing.mixed_documents(named)
    assert mixed.columns == named.columns
    got = Counter()
    for ident, text, _ in plain(mixed):
        got[ident] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    assert {i: n for i, n in taken.items() if n} == {i: n for i, n in got.items() if n}


# --- MinHash -------------------------------------------------------------------------


def plain_components(rows, percent):
    sets = []
    for ident, text, _ in rows:
        w = words_of(text)
        sets.append(frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i : i + 5]) for i in range(len(w) - 4)]))
    links = defaultdict(set)
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            common = len(a & b)
            if common and 100 * common >= percent * (len(a) + len(b) - common):
                links[i].add(j)
                links[j].add(i)
    found, least = {}, {}
    for i in range(len(sets)):
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least[i] = rows[i][0] if not sets[i] else min(ids, default=None)
        found[i] = (rows[i][0], len(sets[i]), least[i], rows[i][0] is not None and rows[i][0] == least[i])
    return sorted(found.values(), key=repr)


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(documents, percent):
    got = near_dedup.near_duplicates(documents, percent)
    assert sorted(map(tuple, got.collect()), key=repr) == plain_components(plain(documents), percent)


def test_a_group_too_large_for_one_block(spark, monkeypatch):
    from tests.llm.conftest import edited, prose

    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    base = prose(9, 200)
    rows = [(i, edited(base, i, (i % 10) / 150), "s") for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    assert sorted(map(tuple, near_dedup.near_duplicates(df).collect()), key=repr) == plain_components(rows, 85)


def test_every_pair_within_the_distance_shares_a_key():
    r = np.random.default_rng(2)
    for _ in range(300):
        a = r.integers(0, 1 << 16, near_dedup.PLACES).astype("<u2")
        b = a.copy()
        b[r.choice(near_dedup.PLACES, 15, replace=False)] ^= 1
        shared = set(near_dedup.keys_of(a.tobytes())) & set(near_dedup.keys_of(b.tobytes()))
        assert shared and int(near_dedup._first_key(a[None], b[None])[0, 0]) == min(k >> 48 for k in shared)


def test_one_of_each(odd):
    kept = {r[0] for r in plain(near_dedup.one_of_each(odd, 85)) if r[0] is not None}
    assert kept == {r[0] for r in plain_components(plain(odd), 85) if r[3]}
    assert near_dedup.one_of_each(odd).columns == odd.columns


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(139, 40), (200, 200), (301, 300)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    assert got == {**{i: 0 for i in [*range(41), *range(100, 140)]}, 300: 300, 301: 300}


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    from millrace.llm import common

    written, settle = [], common.settle
    monkeypatch.setattr(common, "settle", lambda df, label: written.append(label) or settle(df, label))
    pairs = [(10, i) for i in range(11, 40)] + [(2, 1), (2, 1), (3, 3)]
    got = dict(map(tuple, components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()))
    assert got == {**{i: 10 for i in range(10, 40)}, 1: 1, 2: 1}
    # The links, and each node's lowest neighbour: no round of joins.
    assert len(written) == 2


def test_sets_are_taken_from_the_texts_once(odd, monkeypatch):
    plans, usual = {}, near_dedup.settle

    def settle(df, label):
        plans[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return usual(df, label)

    monkeypatch.setattr(near_dedup, "settle", settle)
    assert near_dedup.near_duplicates(odd).count() == odd.count()
    assert plans["sets"].count("ArrowEvalPython") == 1


def test_joins_of_near_duplicates_wait_for_measured_sizes(odd, monkeypatch):
    """An explode is planned as if it made no rows; no join may be broadcast by such a size."""
    plans, usual = [], near_dedup.settle

    def settle(df, label):
        plans.append((label, df._jdf.queryExecution().executedPlan().toString()))
        return usual(df, label)

    monkeypatch.setattr(near_dedup, "settle", settle)
    monkeypatch.setattr(common, "settle", settle)
    conf = odd.sparkSession.conf
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [conf.get(n, None) for n in names]
    found = near_dedup.near_duplicates(odd)
    assert sum("MergeJoin" in p for _, p in plans) >= 5 and [label for label, p in plans if "BroadcastHashJoin" in p] == []
    assert [conf.get(n, None) for n in names] == before
    assert sorted(map(tuple, found.collect()), key=repr) == plain_components(plain(odd), 85)


# --- tokens --------------------------------------------------------------------------


def test_tokens(documents, spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(byte_tokenizer())
    path = f"{tmp_path}/shards"
    token_shards.write_shards(documents, path, byte_tokenizer(), shard_tokens=3000, parts=3)
    rows = sorted(plain(documents), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    want, start, every = [], 0, []
    for ident, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        want.append((ident, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
        every += ids
    got = token_shards.read_shards(spark, path).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    token = Counter(every).most_common(3)[-1][0]
    counts = token_shards.look_up(spark, path, token).collect()
    assert sum(r.n for r in counts) == every.count(token) and len(counts) > 1


def test_words_remembered_encode_like_whole_texts():
    from tokenizers import Tokenizer

    plainly = Tokenizer.from_file(byte_tokenizer())
    encoder = token_shards.Encoder(byte_tokenizer(), entries=20)
    texts = [
        "a b", "a  b", "a   b ", " a", "  a", "it's don't, I'll . x", "x\n y \n z", "x \n\n  y", "tab\t tab \t x", "é ñ, ß.", "1,000.5 2 , 3",
        "<|endoftext|> a <|endoftext|>b", "a\u00a0 b", "a \u00a0 b", "nul\0 x", "word. Word, word.", ".,. ,", "\u2003 x", "x \u200b y", "日本 語, ok", "a\x1c b \x1c c", "a\x85 \x85b",
    ]
    for text in texts * 2:
        assert encoder.encode(text).tolist() == plainly.encode(text, add_special_tokens=False).ids, repr(text)


def test_new_words_of_many_texts_are_encoded_together():
    from tokenizers import Tokenizer

    plainly = Tokenizer.from_file(byte_tokenizer())
    encoder = token_shards.Encoder(byte_tokenizer())
    r = random.Random(3)
    signs = [" "] * 12 + [", ", ". ", ".\n", "\n", "., ", "!", "$$$ ", "'s ", "  ", ".\n ", ".\n\n", " ,", "\t", "×, ", "\u00a0"]
    words = ["".join(r.choices("abcdeéß日", k=r.randint(1, 6))) for _ in range(500)] + ["7", "x1", "İ", "ª", "²", "<|endoftext|>"]
    texts = [None, "", *["".join(r.choice(words) + r.choice(signs) for _ in range(r.randint(0, 30))) for _ in range(400)]]
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert ids.tolist() == plainly.encode(text or "", add_special_tokens=False).ids, repr(text)

    class Counted:
        def __init__(self, tokenizer):
            self.tokenizer, self.calls = tokenizer, 0

        def encode_batch_fast(self, *args, **options):
            self.calls += 1
            return self.tokenizer.encode_batch_fast(*args, **options)

    fresh = token_shards.Encoder(byte_tokenizer())
    fresh.tokenizer, fresh.merges = Counted(fresh.tokenizer), Counted(fresh.merges)
    prose = [f"wörd{'abcdefghij'[i % 10] * (i // 10 + 1)}, next. Last" for i in range(100)]
    # The comma, the stop, and all words in one call.
    assert len(list(fresh.encode_all(prose))) == 100 and fresh.tokenizer.calls + fresh.merges.calls == 3


class Spied:
    """A tokenizer that keeps the pieces it was given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.given = tokenizer, []

    def encode_batch_fast(self, inputs, **options):
        self.given.append(inputs[0])
        return self.tokenizer.encode_batch_fast(inputs, **options)


def test_new_words_of_three_million_characters_are_encoded_in_one_call():
    r = random.Random(5)
    texts = [" ".join("".join(r.choices("abcdefghij", k=9)) for _ in range(1000)) for _ in range(300)]
    encoder = token_shards.Encoder(byte_tokenizer())
    encoder.tokenizer, encoder.merges = Spied(encoder.tokenizer), Spied(encoder.merges)
    assert len(list(encoder.encode_all(texts))) == 300
    assert len(encoder.tokenizer.given) + len(encoder.merges.given) == 1


def test_common_words_stay_remembered(monkeypatch):
    from tokenizers import Tokenizer

    plainly = Tokenizer.from_file(byte_tokenizer())
    monkeypatch.setattr(token_shards, "CHUNK_CHARS", 200)
    encoder = token_shards.Encoder(byte_tokenizer(), entries=60)
    encoder.merges = Spied(encoder.merges)
    common = ["hören", "seen", "mañana", "été"]
    rare = ["x" + "abcdefghij"[i // 100] + "abcdefghij"[i // 10 % 10] + "abcdefghij"[i % 10] for i in range(1000)]
    texts = [" ".join(["the", *common, *rare[i : i + 5], *common]) for i in range(0, 1000, 5)]
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert ids.tolist() == plainly.encode(text, add_special_tokens=False).ids, text
    # Each word once, the first of a text without a space; no more words are kept than were asked for.
    assert sum(map(len, encoder.merges.given)) == 1 + len(common) + len(rare)
    assert len(encoder.words) <= 60 and set(common) <= set(encoder.words.to_pylist())


def test_wavelet_matrix():
    r = np.random.default_rng(0)
    for ids in [np.array([], dtype=np.uint32), np.array([0]), r.integers(0, 50257, 3000), r.zipf(1.5, 5000) % 300, np.array([70000, 3, 70000])]:
        ids = ids.astype(np.uint32)
        w = token_shards.WaveletMatrix.from_bytes(memoryview(token_shards.WaveletMatrix.of(ids).to_bytes()))
        assert w.decode().tolist() == ids.tolist()
        for i in range(0, len(ids), 97):
            assert w.access(i) == ids[i]
        for v in {0, 1, 7, *ids[:5].tolist(), 99999}:
            places = np.flatnonzero(ids == v)
            assert w.rank(v, len(ids)) == len(places)
            assert w.rank(v, len(ids) // 2, len(ids) // 3) == (ids[len(ids) // 3 : len(ids) // 2] == v).sum()
            assert [w.select(v, k) for k in range(len(places))][:20] == places.tolist()[:20] and w.select(v, len(places)) == -1


# --- decontamination -----------------------------------------------------------------


def plain_distance(item, text):
    """Least edits of the item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        above, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(above[j - 1] + (c != d), above[j] + 1, row[-1] + 1))
    return min(row)


def test_leaks_against_plain_distances(spark):
    from tests.llm.conftest import prose
    import random

    r = random.Random(5)
    items = [(i, prose(100 + i, r.randint(8, 25))) for i in range(8)]
    docs = []
    for i in range(40):
        text = items[i % 8][1]
        for _ in range(i % 9):
            at = r.randrange(len(text))
            text = text[:at] + r.choice(["", "q", "qq" + text[at]]) + text[at + 1 :]
        docs.append((i, f"{prose(i, 15).upper()}\n\n {text}\t{prose(i + 1, 12)}" if i != 3 else None))
    got = decontaminate.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items + [(90, None), (91, "")], "item_id bigint, text string"))
    want = set()
    for ident, text in docs:
        for item, said in items:
            least = plain_distance(said, decontaminate.normalise(text))
            if text and least <= int(decontaminate.RATE * len(said)):
                want.add((ident, item, least))
    rows = got.collect()
    assert {(x.doc_id, x.item_id, x.distance) for x in rows} == want and len(rows) == len(want) > 10
    for x in rows:
        found = decontaminate.normalise(dict(docs)[x.doc_id])[x.start : x.stop]
        assert plain_distance(dict(items)[x.item_id], found) == x.distance


def test_items_without_an_id(spark):
    said = "a passage of the benchmark that nobody gave an id"
    docs = spark.createDataFrame([(1, f"before. {said.upper()} after"), (2, "clean"), (None, said)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(None, said), (None, said), (7, said), (None, None)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.leaks(docs, bench).collect()}
    assert got == {(1, None, 0), (1, 7, 0), (None, None, 0), (None, 7, 0)} and decontaminate.leaks(docs, bench).count() == 4


def test_a_benchmark_in_several_rounds(spark, monkeypatch):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.leaks(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "ROUND_BYTES", 3000)
    assert sorted(map(tuple, decontaminate.leaks(docs, bench).collect())) == whole
    exact = {(i, k) for i, t, _ in plain(docs) for k, b in bench.collect() if decontaminate.normalise(b) in decontaminate.normalise(t)}
    assert exact == {r[:2] for r in whole if r[2] == 0}


def test_blocks_are_one_layout_in_any_row_order():
    r = np.random.default_rng(3)
    rows = [(i, f"text {k} " + "ab" * int(r.integers(1, 400))) for i in (None, None, 1, 2, 2, 3) for k in range(40)] + [(None, None), (2, ""), (2, None)]
    laid = []
    for _ in range(3):
        shuffled = [rows[i] for i in r.permutation(len(rows))]
        table = suffix_dedup.pa.table({"doc_id": suffix_dedup.pa.array([x[0] for x in shuffled], "int64"), "text": suffix_dedup.pa.array([x[1] for x in shuffled], "string")})
        block = suffix_dedup._load(table)
        laid.append((block.ids.tolist(), block.raw.tobytes(), block.bounds.tolist()))
    assert laid[0] == laid[1] == laid[2]


def test_rows_without_doc_id_link_others(spark):
    words = [f"w{i}" for i in range(400)]
    ends = [words[:370], words[30:]]
    a, b = (" ".join(w) for w in ends)
    docs = spark.createDataFrame([(1, a), (None, " ".join(words)), (2, b)], "doc_id bigint, text string")
    rows = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, 90).collect()}
    apart = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs.filter("doc_id is not null"), 90).collect()}
    assert rows == {1: 1, None: 1, 2: 1} and apart == {1: 1, 2: 2}


# --- licences ------------------------------------------------------------------------


def test_licences_match_sql(documents):
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [r[:2] for r in plain(documents)])
    want = con.sql(licences.scan_sql()).fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in licences.scan(documents).collect())


def test_licence_rules(spark):
    s = licences.SENTENCES
    texts = [
        "Foo. Released under the MIT License.\nbar", f"{s[7]}. {s[8]}! {s[9]}.", f"{s[8]}.\n{s[7]}.", "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: MIT", None,
        f"{s[10]}:\n{s[11]}.\nother words\n{s[12]}.\n{s[13]}.",
    ]
    got = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert [r.licences for r in sorted(got)] == ["MIT", "MIT", "", "CC-BY-NC-4.0", "MIT", "", "BSD-3-Clause"]
    plan = licences.scan(spark.createDataFrame([(1, "x")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def licences_of(spark, *texts):
    got = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    return [r.licences for r in sorted(got)]


def test_licences_in_the_wording_of_documents(spark):
    lines = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "Licensed under the Apache License, Version 2.0.": "Apache-2.0", "Released under the MIT License.": "MIT",
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "Proprietary",
        "This work is licensed under the GNU General Public License, version 2.": "GPL-2.0",
        "This software is released under the MIT License.": "MIT", "This project is distributed under the BSD 3-Clause License.": "BSD-3-Clause",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.": "CC-BY-SA-4.0",
    }
    assert licences_of(spark, *(f"Some words here.\n{line}\nmore words" for line in lines)) == list(lines.values())
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    line = "This work is licensed under the GNU General Public License, version 3."
    want = {r.doc_id for r in docs.collect() if line in (r.text or "").split("\n")}
    got = {r.doc_id for r in licences.scan(docs).collect() if "GPL-3.0" in r.licences.split(",")}
    assert want and want <= got


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"."""
GPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful."""
MPL = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/."""


def test_unmodified_licence_texts(spark):
    texts = {APACHE: "Apache-2.0", MIT: "MIT", BSD: "BSD-3-Clause", GPL: "GPL", MPL: "MPL-2.0"}
    forms = {
        "wrapped": str, "unwrapped": lambda t: " ".join(t.split()), "one line a paragraph": lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
        "comment": lambda t: "\n".join(f" * {line}" for line in t.split("\n")), "windows": lambda t: t.replace("\n", "\r\n"),
        "within": lambda t: f"Some words.\n\n{t}\n\nOther words: more.",
        "wrapped elsewhere": lambda t: "\n\n".join(textwrap.fill(" ".join(p.split()), 50) for p in t.split("\n\n")),
    }
    got = licences_of(spark, *(made(t) for made in forms.values() for t in texts))
    for at, form in enumerate(forms):
        assert got[at * len(texts) : (at + 1) * len(texts)] == list(texts.values()), form
    assert licences_of(spark, "Nothing of this work is licensed under the MIT License.", "under the terms of the Mozilla Public License, v. 1.1.", "I use the MIT License. 2 cats") == [""] * 3


# --- all -----------------------------------------------------------------------------


def test_empty_tables(spark, none):
    bench = spark.createDataFrame([], "item_id bigint, text string")
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert near_dedup.near_duplicates(none).count() == 0 and near_dedup.one_of_each(none).count() == 0
    assert token_shards.tokenise(none, byte_tokenizer()).count() == 0
    assert decontaminate.leaks(none, bench).count() == 0 and licences.scan(none).count() == 0
    some = spark.read.parquet(f"{SF}/documents.parquet")
    assert decontaminate.leaks(some, bench).count() == 0


def test_queries_are_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names


ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES
WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS."""
LGPL = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
AGPL = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version."""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented."""
BOOST = """Permission is hereby granted, free of charge, to any person or organization
obtaining a copy of the software and accompanying documentation covered by
this license (the "Software") to use, reproduce, display, distribute,
execute, and transmit the Software, and to prepare derivative works of the
Software, and to permit third-parties to whom the Software is furnished to
do so, all subject to the following:"""
RIGHTS = "Copyright (c) 2020, A. Body. All rights reserved.\n\n"


def test_longest_rule_and_reserved_rights(spark):
    two = BSD.partition("3. Neither")[0]
    four = BSD.replace("3. Neither", "3. All advertising materials mentioning features or use of this software\n   must display the following acknowledgement:\n   This product includes software.\n\n4. Neither")
    between = MIT.replace("The above", "All rights reserved.\n\nThe above")
    want = {
        RIGHTS + BSD: "BSD-3-Clause", RIGHTS + two: "BSD-2-Clause", RIGHTS + four: "BSD-4-Clause", RIGHTS + APACHE: "Apache-2.0", between: "MIT", RIGHTS: "Proprietary",
        RIGHTS + ISC: "ISC", ISC.replace("granted, provided that the above\ncopyright notice and this permission notice appear in all copies.", "granted."): "0BSD",
        LGPL: "LGPL-2.1", AGPL: "AGPL-3.0", ZLIB: "Zlib", BOOST: "BSL-1.0", BSD + "\n\n" + two: "BSD-2-Clause,BSD-3-Clause", BSD + "\n\n" + BSD: "BSD-3-Clause",
        "SPDX: BSD-2-Clause": "BSD-2-Clause", "SPDX: GPL-2.0-only": "GPL-2.0", "// SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL-2.1", "SPDX-License-Identifier: AGPL-3.0-or-later": "AGPL-3.0",
        "This file is distributed under the terms of the Boost Software License, Version 1.0.": "BSL-1.0", "Licensed under the EUPL, Version 1.2.": "EUPL-1.2",
        "The licence \x01\x02 MIT.\x01Released under\x02the MIT License.": "MIT",
    }
    assert licences_of(spark, *want) == list(want.values())


def test_wrapped_texts_match_sql(spark):
    whole = [APACHE, MIT, BSD, GPL, MPL, ISC, LGPL, AGPL, ZLIB, BOOST, RIGHTS + BSD, "Released under the MIT License.", "v. 2.0; v. x: y\x01z\x02.\r\n\r\nSPDX: MIT"]
    texts = [f(t) for t in whole for f in (str, lambda t: " ".join(t.split()), lambda t: "\n".join(f" * {x}" for x in t.split("\n")), lambda t: t.replace("\n", "\r\n") + "\n" + t, lambda t: textwrap.fill(t, 33))]
    con = duckdb.connect()
    con.sql("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", list(enumerate(texts)))
    got = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(con.sql(licences.scan_sql()).fetchall()) and all(r.licences for r in got)
