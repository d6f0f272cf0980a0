"""Web archives: round trips against a plain grouping, equal files, recovery."""

import base64
import hashlib
import io
import os
import random

import pytest

from millrace.llm import warc

SCHEMA = "page_id bigint, url string, html string, sha string, place string, shard string, payload string, narrow string, chunk string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", "x", "x", "x", "x", "x") for r in rows], SCHEMA).repartition(parts)


def odd_pages(seed=0):
    r = random.Random(seed)
    bodies = ["", "<p>é</p>", "<p>" + "long " * 60_000 + "</p>", *(f"<p>{i}" + "x" * r.randrange(200) for i in range(20))]
    rows = [(i, f"http://a/{i % 7}", r.choice(bodies)) for i in range(300)]
    rows += [(1000 + i, "http://copy/", "<p>the same</p>") for i in range(200)]
    rows += [(5, "http://hot/", f"<p>{i % 90}") for i in range(300)]
    rows += [(-3, None, None), (-3, "", None), (-4, " http://b/\r\nX: y  ", "q"), (None, "http://n/", "q"), (None, None, "only"), (7, "u", "\r\n\r\n")]
    return rows + [(2**62, "http://far/", "far"), (-(2**63), "http://far/", "far")] + [(8, "http://r/", "again")] * 25


def expected(rows, least=0):
    """(page_id, n, digest, type, refers_to) of every row; of equal payloads the smallest page_id, nulls last, stays."""
    first, out = {}, []
    for page_id, url, html in rows:
        body = (html or "").encode()
        if len(body) >= least:
            first.setdefault(body, []).append((page_id is None, page_id or 0, page_id))
    lead = {body: min(ids)[2] for body, ids in first.items()}
    given = set()
    for page_id, url, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        answers = len(body) < least or (lead[body] == page_id and body not in given)
        if answers:
            given.add(body)
        out.append((page_id, len(body), digest, "response" if answers else "revisit", None if answers else lead[body]))
    return sorted(out, key=repr)


def told(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=repr)


@pytest.mark.parametrize("least", [0, 5, 10_000])
def test_round_trip(spark, tmp_path, least):
    rows, path = odd_pages(), str(tmp_path / "out")
    warc.write_archive(frame(spark, rows), path, least_bytes=least, shard_bytes=20_000, roll_bytes=3_000)
    records = warc.read_archive(spark, path).cache()
    assert told(records) == expected(rows, least)
    texts = {base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode(): (h or "").encode() for _, _, h in rows}
    for r in records.collect():
        assert r.payload == (texts[r.payload_digest] if r.record_type == "response" else None)
    urls = {r.url for r in records.filter("page_id = -3").collect()}
    assert urls == {None, ""} and records.filter("page_id = -4").first().url == "%20http://b/%0D%0AX: y %E2%80%A8"
    files = warc.read_manifest(spark, path).collect()
    assert len(files) > 10 and len({f.shard for f in files}) > 5 and sum(f.n_records for f in files) == len(rows)
    assert sorted(os.listdir(path)) == sorted(["manifest", *(f.file for f in files)])
    # The shards are ranges: no page_id of a later shard is before one of an earlier shard.
    spans = records.filter("page_id is not null").groupBy("file").agg({"page_id": "min"}).collect()
    ends = {r.file: r[1] for r in records.filter("page_id is not null").groupBy("file").agg({"page_id": "max"}).collect()}
    order = sorted((r.file, r[1]) for r in spans)
    assert all(ends[a[0]] <= b[1] for a, b in zip(order, order[1:]))


def test_files_are_equal_however_rows_arrive(spark, tmp_path):
    rows, sums = odd_pages(1), []
    for run, parts in enumerate((1, 5)):
        random.Random(run).shuffle(rows)
        path = str(tmp_path / f"run{run}")
        warc.write_archive(frame(spark, rows, parts), path, shard_bytes=15_000, roll_bytes=2_000)
        sums.append({f: hashlib.sha256(open(f"{path}/{f}", "rb").read()).hexdigest() for f in os.listdir(path) if f.endswith(".gz")})
    assert sums[0] == sums[1] and len(sums[0]) > 10


def test_a_page_id_with_most_records_is_cut(spark):
    rows = [(4, f"http://a/{i}", f"<p>{i}" + "y" * 500) for i in range(400)] + [(i, "u", f"{i}") for i in range(40)]
    records = warc.plan_records(frame(spark, rows))
    cuts = warc.cut_places(records, 20_000)
    sizes = [r[1] for r in records.groupBy(warc.shard_of(cuts)("at")).agg({"weight": "sum"}).collect()]
    assert len(sizes) == len(cuts) + 1 > 15 and max(sizes) <= 20_000


def test_publishing_again_after_a_failure(spark, tmp_path, monkeypatch):
    """The driver dies between the files and their list: nothing can be read, and the work can be taken up."""
    rows, path, kept = odd_pages(2), str(tmp_path / "out"), []

    def dies(manifest, where):
        kept.append(manifest)
        raise RuntimeError("driver lost")

    publish = warc.publish
    monkeypatch.setattr(warc, "publish", dies)
    with pytest.raises(RuntimeError):
        warc.write_archive(frame(spark, rows), path, shard_bytes=50_000)
    assert not os.path.exists(f"{path}/manifest")
    one = kept[0].first()
    os.rename(f"{path}/{one.pending}", f"{path}/{one.file}")
    publish(kept[0], path)
    assert told(warc.read_archive(spark, path)) == expected(rows)
    with pytest.raises(FileExistsError):
        warc.write_archive(frame(spark, rows), path)


def test_damage_is_seen(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_archive(frame(spark, [(1, "u", "<p>text</p>")]), path)
    name = warc.read_manifest(spark, path).first().file
    raw = b"".join(warc.members(open(f"{path}/{name}", "rb")))
    assert raw.count(b"WARC/1.1\r\n") == 2 and b"WARC-Type: warcinfo" in raw
    record = raw[raw.rindex(b"WARC/1.1") :]
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"<p>text", b"<p>tExt"))
    assert b"".join(warc.members(open(f"{path}/{name}", "rb"), 50)) == raw
    cut = open(f"{path}/{name}", "rb").read()[:-9]
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(cut)))


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "out")
    warc.write_archive(frame(spark, []), path)
    assert warc.read_archive(spark, path).count() == 0 and os.listdir(path) == ["manifest"]


def test_payload_met_before_is_sent_once(spark):
    rows = [(i, "u", "<p>copy</p>") for i in range(500)]
    pages = warc._payloads(frame(spark, rows, 2)).select("page_id", "url", "payload", "sha", "n_bytes", "mark", "place").coalesce(1)
    sent = pages.sortWithinPartitions("place").mapInArrow(warc._first_met, pages.schema)
    assert sent.count() == 1
