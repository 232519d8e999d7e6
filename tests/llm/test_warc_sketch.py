"""WARC round trips, and document sketches against brute force."""

import gzip
import hashlib
import io
import random

import pytest

from quarry.llm import sketch as sk
from quarry.llm import warc
from quarry.llm.common import scratch_path


# -- WARC --------------------------------------------------------------------

BIG = "<p>ünï</p>" * 50_000


def test_round_trip_in_chunks(spark):
    same = "s" * 150
    pages = [(5, "http://a/ b", same), (3, "http://a/\r\nX: y", same), (9, None, same), (1, "u", "tiny"), (2, "u", "tiny"), (4, "u", None),
             (6, "u", ""), (7, "u", BIG), (8, "u", "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9), (None, "u", same), (None, "v", "n" * 200), (None, "v", "n" * 200),
             (10, "u", "é" * 50), (11, "u", "é" * 50), (12, "u", "x" * 99), (13, "u", "x" * 99)]
    frame = spark.createDataFrame([(*p, "d") for p in pages], "page_id long, url string, html string, digest string")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_warc(frame, folder, chunk_bytes=1000)
    rows = warc.read_warc(manifest, folder, chunk_bytes=777).collect()
    assert max(len(r.data) for r in rows) <= 777
    by_record = {}
    for r in sorted(rows, key=lambda r: r.chunk_no):
        sha, parts = by_record.setdefault((r.record_id, r.url), (hashlib.sha256(), []))
        if r.record_type == "response" and r.page_id is not None:
            sha.update(r.data)
            assert r.digest == sha.hexdigest()
        parts.append(r.data)
    assert b"".join(by_record[next(k for k in by_record if ":i7:" in k[0])][1]).decode() == BIG
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.round_trip(frame).collect()), key=str)
    first = {same: 3, "é" * 50: 10}
    want = []
    for page_id, _, html in pages:
        body = (html or "").encode()
        again = html in first and page_id != first[html]
        want.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    assert got == sorted(want, key=str)
    assert {r.url for r in rows if r.page_id == "3"} == {"http://a/%0D%0AX:%20y"}
    assert sum(r.n_records for r in manifest.collect()) == len(pages)
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_urls_stay_as_they_are(spark):
    urls = ["http://a/a%20b", "http://a/%2F?x=%25", "http://a/100%", "https://x.org/a%20b?q=%2F", "http://a/\"<>^`{|}"]
    odd = {"http://a/a b": "http://a/a%20b", "http://a/é%C3%A9": "http://a/%C3%A9%C3%A9", "http://a/\t\x7f": "http://a/%09%7F"}
    want = urls + list(odd.values())
    frame = spark.createDataFrame(list(enumerate(urls + list(odd))), "page_id long, url string").selectExpr("*", "'p' AS html")
    folder = scratch_path(spark, "warc-escapes")
    rows = warc.read_warc(warc.write_warc(frame, folder), folder).collect()
    assert {int(r.page_id): r.url for r in rows} == dict(enumerate(want))
    assert b"WARC-Target-URI: https://x.org/a%20b?q=%2F\r\n" in warc._head("1", urls[3], 1, "0", "response", None, "2024-01-01T00:00:00Z")


def test_archives_of_other_writers():
    body = b"HTTP/1.1 200 OK\r\nX: " + b"y" * 200_000 + b"\r\n\r\nabc"
    record = (b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: http://o/a%20b\r\nWARC-Record-ID: <urn:uuid:1>\r\n"
              b"Content-Type: application/http\r\nContent-Length: " + str(len(body)).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")
    got = list(warc.read_records(io.BytesIO(record), 1 << 20))
    assert [(r["url"], r["payload_bytes"], r["data"]) for r in got] == [("http://o/a%20b", 3, b"abc")]

    class Endless(io.RawIOBase):  # what has no line end is not read to its end
        taken = 0

        def readline(self, size=-1):
            assert 0 < size <= warc.MAX_HEADER
            self.taken += size
            return b"x" * size

    with pytest.raises(ValueError):
        list(warc.read_records(Endless(), 4))
    assert Endless.taken == 0


def test_reader_refuses_cut_archives():
    head = warc._head("1", "u", 10, hashlib.sha256(b"0123456789").hexdigest(), "response", None, "2024-01-01T00:00:00Z")
    whole = head + warc.HTTP + b"0123456789\r\n\r\n"
    assert [r["payload_bytes"] for r in warc.read_records(io.BytesIO(whole * 2), 4) if r["is_last"]] == [10, 10]
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(whole[:-8]), 4))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(b"HTTP/1.1 200 OK\r\n"), 4))
    packed = gzip.compress(whole) * 3
    assert sum(r["is_last"] for r in warc.read_records(gzip.GzipFile(fileobj=io.BytesIO(packed)), 3)) == 3


# -- sketches ----------------------------------------------------------------

def shingles(text, n=5):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def edited(text, nxt):
    cut = len(text) // 3
    return text[: len(text) - cut] + nxt[:cut]


def test_report_against_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"wörd{i}" for i in range(3000)]
    docs = [(i * 7 % 101, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 3, 20, 400, 900])))) for i in range(101)]
    docs += [(None, "last of all"), (500, None), (501, ""), (502, "x y " * 20_000), (503, "🙂é" * 10)]
    frame = spark.createDataFrame([(*d, 1, 2) for d in docs], "doc_id long, text string, sketch int, _range int").repartition(4)
    got = {r.id: r for r in sk.fingerprint_report(frame, k=64).collect()}
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))
    errors = []
    for (i, text), (_, nxt) in zip(order, order[1:] + order[:1]):
        text, nxt = text or "", nxt or ""
        r, e = got[i], edited(text, nxt)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(e.encode()).hexdigest()
        errors.append(abs(r.near_edited - jaccard(shingles(text), shingles(e))))
        assert abs(r.near_next - jaccard(shingles(text), shingles(nxt))) < 0.3
    assert len(got) == len(docs) and sum(errors) / len(errors) < 0.05 and max(errors) < 0.3


def test_small_tables_and_ties(spark):
    schema = "doc_id long, text string"
    one = sk.fingerprint_report(spark.createDataFrame([(1, "abcdef")], schema)).collect()
    assert one[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest() and one[0].near_next == 1
    same = sk.fingerprint_report(spark.createDataFrame([(1, "a b c")] * 3 + [(None, None)] * 2, schema)).collect()
    assert len(same) == 5 and len({tuple(r.sketch) for r in same}) == 2
    assert sk.fingerprint_report(spark.createDataFrame([], schema)).count() == 0


def test_merge_containment_counts_and_strings(spark):
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(n)) for n in (2000, 700, 3, 0)]
    texts.append(texts[0] + " " + texts[1])
    frame = sk.with_sketch(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), sk.F.col("text"), "s")
    rows = {r.i: r for r in frame.withColumn("n", sk.distinct_shingles(sk.F.col("s"))).withColumn(
        "back", sk.from_string(sk.as_string(sk.F.col("s"))) == sk.F.col("s")).collect()}
    for i, t in enumerate(texts):
        assert rows[i].back and rows[i].n == pytest.approx(len(shingles(t)), rel=0.3)
        assert rows[i].s == sorted(rows[i].s) and len(rows[i].s) == min(sk.K, len(shingles(t)))
    parts = spark.createDataFrame([("g", rows[0].s), ("g", rows[1].s), ("e", []), (None, rows[2].s)], "g string, s array<bigint>")
    merged = {r.g: r.s for r in sk.merge_groups(parts, ["g"], "s").collect()}
    whole = sorted(set(rows[0].s) | set(rows[1].s))[:sk.K]
    assert merged == {"g": whole, "e": [], None: rows[2].s}
    pair = spark.createDataFrame([(rows[1].s, rows[4].s)], "a array<bigint>, b array<bigint>")
    r = pair.select(sk.containment(sk.F.col("a"), sk.F.col("b")).alias("c"), sk.merge(sk.F.col("a"), sk.F.col("a")).alias("m"),
                    sk.resemblance(sk.F.col("a"), sk.F.col("b")).alias("r")).first()
    assert r.c > 0.7 and r.m == rows[1].s and abs(r.r - jaccard(shingles(texts[1]), shingles(texts[4]))) < 0.2


def test_text_ids_have_next_documents(spark):
    rows = [(f"doc-{i * 7919 % 1000:04d}-é", f"word{i} one two three four five") for i in range(300)] + [(None, "no id"), ("doc-0001-é", "again")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = {(r.id, r.n_chars): r.edited_sha256 for r in sk.fingerprint_report(docs).collect()}
    order = sorted((r for r in rows if r[0] and rows.count(r) == 1 and r[0] != "doc-0001-é"), key=lambda r: r[0].encode(), reverse=True)
    checked = 0
    for a, b in zip(order, order[1:]):
        if b[0] > "doc-0001-é":
            cut = len(a[1]) // 3
            text = a[1][:len(a[1]) - cut] + b[1][:cut]
            assert got[(a[0], len(a[1]))] == hashlib.sha256(text.encode()).hexdigest()
            checked += 1
    assert checked > 200 and len(sk.fingerprint_report(docs).collect()) == len(rows)
