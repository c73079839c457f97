"""WARC archives: contents, revisits, rolling, determinism and recovery."""

import gzip
import hashlib
import os
import uuid

import pytest

from routekpi.llm import warc

BIG = "<p>" + "é" * 700 + "</p>"


def pages():
    rows = [(i, f"http://h{i % 7}.example/{i}", f"<html>{i} " + "x" * (i * 37 % 2600) + "</html>") for i in range(120)]
    rows += [(200, "http://a.example/1", BIG), (203, "http://a.example/2", BIG), (201, None, BIG), (203, "http://b.example", BIG)]
    rows += [(300, "http://c.example", "small"), (301, "http://c.example", "small"), (302, "http://d e\r\nX: y/ü", None), (303, "", "")]
    rows += [(400, "http://same.example", BIG + "!")] * 5 + [(401, "http://same.example", "tiny")] * 3
    rows += [(None, "http://n.example/1", BIG + "?"), (None, None, BIG + "?"), (None, None, None), (None, None, None)]
    return rows


def frame(spark, rows, parts=3):
    made = [(*r, "x", "y", 1) for r in rows]
    return spark.createDataFrame(made, "page_id long, url string, html string, digest string, shard string, n int").repartition(parts)


def at(scratch):
    return f"{scratch}/{uuid.uuid4().hex}"


def files(path):
    return {n: open(f"{path}/{n}", "rb").read() for n in sorted(os.listdir(path)) if n.endswith(".warc.gz")}


def expected(rows):
    groups = {}
    for i, _, h in rows:
        groups.setdefault(h or "", []).append(i)
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        held = groups[h or ""]
        lead = max((x for x in held if x is not None), default=None)
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), len(held) > 1 and len(data) >= 1000, lead))
    return out


def test_round_trip(spark, scratch):
    rows, path = pages(), at(scratch)
    made = warc.write_archives(frame(spark, rows), path, shard_bytes=40_000, file_bytes=4_000)
    got = warc.read_archives(spark, path, with_payload=True)
    held = [r.asDict() for r in warc.restore(got).collect()]
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(((r["page_id"], bytes(r["payload"])) for r in held), key=key) == sorted(((i, (h or "").encode()) for i, _, h in rows), key=key)
    plain = got.collect()
    assert len({r.record_id for r in plain}) == len(rows) == made.agg({"records": "sum"}).first()[0]
    want = expected(rows)
    assert sorted((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest) for r in plain) == sorted((i is None, i, n, d) for i, n, d, _, _ in want)
    by = {}
    for r in plain:
        by.setdefault(r.payload_digest, []).append(r)
    for i, n, d, shared, lead in want:
        kinds = [r for r in by[d] if r.record_type == "response"]
        if shared:  # one response, with the largest id
            assert len(kinds) == 1 and kinds[0].page_id == lead
            assert all(r.refers_to == lead and r.refers_to_record == kinds[0].record_id for r in by[d] if r.record_type == "revisit")
        else:
            assert len(kinds) == len(by[d])
    uris = {r.page_id: r.target_uri for r in plain}
    assert uris[302] == "http://d%20e%0D%0AX:%20y/%C3%BC" and uris[201] is None and uris[303] == ""


def test_files_are_a_function_of_the_rows(spark, scratch):
    rows, a, b = pages(), at(scratch), at(scratch)
    warc.write_archives(frame(spark, rows, 1), a, shard_bytes=40_000, file_bytes=4_000)
    warc.write_archives(frame(spark, rows[::-1], 7), b, shard_bytes=40_000, file_bytes=4_000)
    assert files(a) == files(b) and len(files(a)) > 8
    made = {r.file: r for r in warc.manifest(spark, a).collect()}
    assert set(made) == set(files(a)) and len({r.shard for r in made.values()}) > 2 and max(r.seq for r in made.values()) > 0
    ids = []
    for name, data in files(a).items():
        assert (len(data), hashlib.sha256(data).hexdigest()) == (made[name].bytes, made[name].sha256)
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
        ids += [warc.page_of(line[17:-1]) for line in gzip.decompress(data).decode().split("\r\n") if line.startswith(f"WARC-Record-ID: <{warc._URN}")]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))
    assert not any(n.startswith("_") for n in os.listdir(a))


def test_many_equal_rows_are_cut(spark, scratch, monkeypatch):
    monkeypatch.setattr(warc, "COPIES", 16)
    rows, path = [(None, None, None)] * 100 + [(1, "u", BIG)] * 50, at(scratch)
    made = warc.write_archives(frame(spark, rows), path, shard_bytes=8_000)
    assert len({r.shard for r in made.collect()}) > 5
    got = warc.read_archives(spark, path).collect()
    assert len({r.record_id for r in got}) == 150
    assert [sum(r.record_type == t and r.page_id == i for r in got) for t, i in (("response", None), ("revisit", None), ("response", 1), ("revisit", 1))] == [100, 0, 1, 49]


def test_empty_and_committed_archives(spark, scratch):
    path = at(scratch)
    assert warc.write_archives(frame(spark, [(1, "u", "h")]).limit(0), path).count() == 0
    assert warc.read_archives(spark, path).count() == 0
    with pytest.raises(FileExistsError):
        warc.write_archives(frame(spark, [(1, "u", "h")]), path)


def test_an_unfinished_run_leaves_no_archive(spark, scratch):
    path = at(scratch)
    os.makedirs(f"{path}/_temporary")
    open(f"{path}/_temporary/pages-00000-00000.warc.gz.0-dead", "wb").write(b"half")
    open(f"{path}/pages-00009-00000.warc.gz", "wb").write(b"renamed by a run that ended before its manifest")
    with pytest.raises(Exception, match="(?i)path|exist"):
        warc.read_archives(spark, path).count()
    warc.write_archives(frame(spark, [(1, "u", "h")]), path)
    assert [r.page_id for r in warc.read_archives(spark, path).collect()] == [1]


def test_damage_is_an_error(spark, scratch):
    path = at(scratch)
    warc.write_archives(frame(spark, [(1, "u", BIG)]), path)
    name, data = next(iter(files(path).items()))
    raw = gzip.decompress(data)
    open(f"{path}/{name}", "wb").write(gzip.compress(raw.replace("é".encode(), b"xy")))
    with pytest.raises(Exception, match="damaged"):
        warc.read_archives(spark, path).collect()
