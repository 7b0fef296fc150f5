"""Zstandard archives, periodic runs, fill-in-middle: round trips, brute force, awkward tables."""

import collections
import hashlib
import json
import random
import re
import struct
import zlib
from fractions import Fraction

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.common import LONG, TEXTS, WORD, awkward, empty
from tidewatch.llm import piece_table, queries, square_catcher, warc_archive, words

SF = "/root/testdata/sf0.001"


# --- word hashes in pieces

def test_span_hashes_do_not_depend_on_the_pieces(monkeypatch):
    rng = np.random.default_rng(0)
    buf = rng.integers(97, 100, 5_000).astype(np.uint8)
    buf[rng.random(5_000) < 0.02] = 32
    buf[1_000:1_700] = 98  # a word longer than a small piece
    starts, ends, _ = words.word_spans(buf, np.array([0, 2_500, 5_000]), words.NON_SPACE)
    whole = words.span_hashes(buf, starts, ends)
    monkeypatch.setattr(words, "PIECE_BYTES", 64)
    monkeypatch.setattr(words, "_powers", None)
    assert (words.span_hashes(buf, starts, ends) == whole).all()
    texts = [buf[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert len(set(whole.tolist())) == len(set(texts))


# --- periodic runs

def brute_runs(w, least=24, times=3):
    """Runs by walking every period over all words."""
    n, seen = len(w), {}
    for p in range(1, n // times + 1):
        x = 0
        while x + p < n:
            if w[x] != w[x + p]:
                x += 1
                continue
            a = x
            while x + p < n and w[x] == w[x + p]:
                x += 1
            if x - a + p >= max(least, times * p):
                seen.setdefault((a, x + p), p)
    return sorted((a, e - a, p) for (a, e), p in seen.items())


def hashed(w):
    return words.mix(np.array(w, dtype=np.uint64) + np.uint64(7))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=90), st.integers(0, 40), st.integers(1, 12), st.sampled_from([3, 8, 24]), st.integers(0, 2**20))
def test_runs_match_brute_force_in_one_and_in_many_appends(w, a, p, least, seed):
    rng = random.Random(seed)
    w = w + [w[min(a, len(w) - 1) + (i % p) - p] if w and min(a, len(w) - 1) >= p else i % p for i in range(rng.randrange(60))]
    if w and rng.random() < 0.3:
        w[rng.randrange(len(w))] = 9
    whole = square_catcher.Catchers(least)
    whole.append(hashed(w), last=True)
    want = brute_runs(w, least)
    assert [tuple(r) for r in whole.runs().tolist()] == want
    online, i = square_catcher.Catchers(least), 0
    while i < len(w):
        step = rng.randrange(1, 9)
        online.append(hashed(w[i:i + step]))
        i += step
    assert [tuple(r) for r in online.finish().tolist()] == want


def test_squares_are_reported_once_when_completed():
    online, told = square_catcher.Catchers(least_length=6), []
    for k, w in enumerate([5, 1, 2, 1, 2, 1, 2, 8, 8, 9]):
        told += [(k, *s) for s in online.append(hashed([w])).tolist()]
    assert told == [(5, 1, 2), (8, 7, 1)]  # words 1 to 4 once the block of words 2 and 3 is repeated; words 7 and 8
    assert online.finish().tolist() == [[1, 6, 2]]


def test_overlap_free_and_degenerate_words():
    thue_morse = square_catcher.Catchers()
    thue_morse.append(hashed([bin(i).count("1") % 2 for i in range(1 << 13)]), last=True)
    assert len(thue_morse.runs()) == 0  # cubes never occur; sums modulo 2**64 would find some
    flat = square_catcher.Catchers()
    flat.append(hashed([0] * 30_000 + [1] + [0] * 20_000), last=True)
    assert flat.runs().tolist() == [[0, 30_000, 1], [30_001, 20_000, 1]]
    with pytest.raises(ValueError):
        square_catcher.Catchers(least_times=2)


def expected(w):
    runs = brute_runs(w)
    dropped = {x for s, n, q in runs for x in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    return runs, best, " ".join(x for i, x in enumerate(w) if i not in dropped)


def test_runs_of_documents(spark):
    rng = random.Random(3)
    texts = ["a b\tc\n" * 9, "start " + "x " * 40 + "mid " + "x " * 30 + "é" * 3, " ".join(rng.choice("ab") for _ in range(400)), "漢　字 " * 30]
    rows = list(enumerate(texts))
    for r in square_catcher.find_runs(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"]).collect():
        runs, best, collapsed = expected(WORD.findall(texts[r.doc_id]))
        assert [tuple(x) for x in r.runs] == runs and (r.greatest and tuple(r.greatest)) == best and r.collapsed == collapsed
        assert r.n_words == len(WORD.findall(texts[r.doc_id]))


def test_runs_of_awkward_tables(spark):
    docs = awkward(spark).withColumns({c: F.lit(3) for c in ("k0", "runs", "greatest", "collapsed")})
    got = square_catcher.find_runs(docs, ["doc_id", "k0", "runs"]).toDF("doc_id", "k0", "mine", "n", "runs", "greatest", "collapsed").collect()
    assert len(got) == docs.count() and {(r.k0, r.mine) for r in got} == {(3, 3)}
    for r in got:
        text = TEXTS[r.doc_id] if r.doc_id is not None else ("no id" if r.n else None)
        if text not in (LONG, "1 " * 5_000):
            runs, _, collapsed = expected(WORD.findall(text or ""))
            assert [tuple(x) for x in r.runs] == runs and r.collapsed == collapsed
    assert {(r.n, len(r.runs), r.collapsed) for r in got if r.doc_id is not None and TEXTS[r.doc_id] == "1 " * 5_000} == {(5_000, 1, "1")}
    assert square_catcher.find_runs(empty(spark), ["doc_id"]).count() == 0


def test_run_query_matches_brute_force(spark):
    got = {r.doc_id: r for r in queries.QUERIES["op12_square_catcher"](spark, SF).collect()}
    checked = collections.Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        w = WORD.findall(r.text or "")
        h, n = zlib.crc32(str(r.doc_id).encode()), len(w)
        if n > 1_500:
            continue
        if h % 10 == 0 and n:
            a, g = (h // 10) % n, h // 10
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs, best, collapsed = expected(w)
        mine = got[r.doc_id]
        assert mine.n_runs == len(runs) and (mine.start, mine.length, mine.period) == (best or (None,) * 3)
        assert mine.exponent_milli == (best and 1000 * best[1] // best[2])
        assert mine.runs_sha256 == hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest()
        assert mine.collapsed_sha256 == hashlib.sha256(collapsed.encode()).hexdigest()
        checked[bool(runs)] += 1
    assert checked[True] > 10 and checked[False] > 50 and len(got) == 200


# --- fill-in-middle

@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab<PSM>é漢👍 \n", max_size=40), st.integers(0, 10_000))
def test_outputs_restore_exactly(text, key):
    raw = text.encode()
    table, form, n, prefix, middle = piece_table.split_text(raw, f"1:{key}")
    out = table.written()
    assert n == len(text) and table.sha256() == hashlib.sha256(out).hexdigest()
    if form == piece_table.PLAIN:
        assert out == raw and (prefix, middle) == (None, None)
    else:
        a, b, c = text[:prefix], text[prefix:prefix + middle], text[prefix + middle:]
        assert out.decode() == {"psm": f"<P>{a}<S>{c}<M>{b}", "spm": f"<S>{c}<P>{a}<M>{b}"}[form]
    back = piece_table.restore_table(out, form)
    assert back.written() == raw and back.sha256() == hashlib.sha256(raw).hexdigest()


def test_pieces_are_cut_and_permuted():
    table = piece_table.PieceTable.of(b"abcdef")
    table.cut(4)
    table.cut(1)
    assert table.pieces == [(0, 0, 1), (0, 1, 3), (0, 4, 2)]
    arranged = table.arranged("spm")
    assert arranged.written() == b"<S>ef<P>a<M>bcd" and table.written() == b"abcdef"
    table.cut(6)
    assert table.pieces[-1] == (0, 6, 0)
    with pytest.raises(IndexError):
        table.cut(7)
    for broken, form in ((b"", "psm"), (b"<P>a<M>b", "psm"), (b"<S>a<P>b", "spm"), (None, "psm"), (b"x", "other"), (b"x", None)):
        assert piece_table.restore_table(broken, form) is None


def test_fill_in_middle_of_tables(spark):
    docs = awkward(spark).withColumns({c: F.lit(3) for c in ("n2", "form", "output", "pieces", "k0", "salted")})
    made = piece_table.fill_in_middle(docs, ["doc_id", "k0", "text"])
    assert made.columns == ["doc_id", "k0", "text", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "pieces"]
    rows = made.collect()
    assert len(rows) == docs.count()
    for r in rows:
        text = r.text or ""
        buffers = {"text": text.encode(), "sentinel": b"<P><S><M>"}
        assert b"".join(buffers[p.buffer][p.start:p.start + p.length] for p in r.pieces).decode() == r.output
        assert r.n == len(text) and (r.form == "plain") == (r.prefix_chars is None)
    restored = piece_table.restore(made.select("text", F.struct("output", "form").alias("o")).select("text", "o.*"), ["text"]).toDF("was", "sha", "now").collect()
    assert all((r.was or "") == r.now and r.sha == hashlib.sha256(r.now.encode()).hexdigest() for r in restored)
    assert piece_table.fill_in_middle(empty(spark), ["doc_id"]).count() == 0
    broken = spark.createDataFrame([("<P>x", "psm"), (None, "plain"), ("y", None)], "output string, form string")
    assert [tuple(r) for r in piece_table.restore(broken, []).collect()] == [(None, None)] * 3


# --- archives

def pages_table(spark):
    rows = [(3, "http://a.org/x y", "<p>one</p>"), (1, "http://b.org/", "<p>one</p>"), (2, None, None), (4, "u\r\nX: y", ""), (5, "http://c.org/", "é漢" * 5_000),
            (None, "http://n.org/", "<p>one</p>"), (None, "http://n.org/2", "only without a key"), (1, "http://b.org/again", "<p>one</p>"), (7, "h", "x" * 300_000)]
    rows += [(100 + i, f"http://many.org/{i}", "copied page " * 20) for i in range(300)]
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(0) for c in ("digest", "first", "salt", "bytes", "key")}), rows


def brute_archive(rows, least):
    groups = collections.defaultdict(list)
    for key, _, html in rows:
        groups[html or ""].append(key)
    out = collections.Counter()
    for key, _, html in rows:
        body = (html or "").encode()
        first = min((k for k in groups[html or ""] if k is not None), default=None)
        revisit = len(body) >= least and first is not None and key != first
        digest = warc_archive.base32_digest(hashlib.sha1(body).hexdigest())
        out[(key, len(body), digest, "revisit" if revisit else "response", first if revisit else None)] += 1
    return out


@pytest.mark.parametrize(("least", "archive_bytes"), [(0, 32 << 20), (20, 2_000)])
def test_archives_read_back(spark, tmp_path, least, archive_bytes):
    pages, rows = pages_table(spark)
    path = warc_archive.write_archives(pages, f"file://{tmp_path}/w", least_bytes=least, archive_bytes=archive_bytes)
    back = warc_archive.read_archives(spark, path)
    got = collections.Counter()
    payloads = {warc_archive.base32_digest(hashlib.sha1((h or "").encode()).hexdigest()): (h or "").encode() for _, _, h in rows}
    for r in back.select("*", warc_archive.key_of(F.col("record_id")).cast("long").alias("k"), warc_archive.key_of(F.col("refers_to")).cast("long").alias("f")).collect():
        assert r.error is None
        got[(r.k, r.payload_bytes, r.payload_digest, r.warc_type, r.f)] += 1
        assert r.payload is None if r.warc_type == "revisit" else bytes(r.payload) == payloads[r.payload_digest]
    assert got == brute_archive(rows, least)
    uris = {r.target_uri for r in back.where("target_uri is null or target_uri like 'u%' or target_uri like '%x%y'").collect()}
    assert uris == {None, "u%0D%0AX: y".replace(" ", "%20"), "http://a.org/x%20y"}
    assert (back.select("archive").distinct().count() > 10) == (archive_bytes == 2_000)


def test_archives_of_nothing(spark, tmp_path):
    pages, _ = pages_table(spark)
    path = warc_archive.write_archives(pages.limit(0), f"file://{tmp_path}/w")
    assert warc_archive.read_archives(spark, path).count() == 0


def archive(payloads, dictionary=None, **options):
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(dict_data=known, write_checksum=True, **options)
    made = [warc_archive.record_bytes(warc_archive.Page(k, f"u{k}", p, warc_archive.base32_digest(hashlib.sha1(p).hexdigest()), None, False), "2020-01-01T00:00:00Z")
            for k, p in enumerate(payloads)]
    return made, [packer.compress(r) for r in made]


def test_dictionary_comes_from_the_leading_frame():
    rng = random.Random(1)
    samples = [json.dumps({f"field{rng.randrange(9)}": rng.randrange(10**6) for _ in range(40)}).encode() * 3 for _ in range(300)]
    dictionary = zstandard.train_dictionary(4_096, samples, k=64, d=8).as_bytes()
    made, frames = archive(samples[:20], dictionary)
    plain = warc_archive.dictionary_frame(dictionary)
    packed = warc_archive.dictionary_frame(zstandard.ZstdCompressor().compress(dictionary))
    for head in (plain, packed):
        found = list(warc_archive.records(memoryview(head + b"".join(frames))))
        assert [f["payload"] for _, f, _ in found] == samples[:20] and all(e is None for _, _, e in found)
    without = list(warc_archive.records(memoryview(b"".join(frames))))
    assert len(without) == 20 and all(e.startswith("frame:") for _, _, e in without)
    wrong = list(warc_archive.records(memoryview(warc_archive.dictionary_frame(b"nothing") + b"".join(frames[:1]))))
    assert wrong[0][2].startswith("dictionary:") and len(wrong) == 2


def test_damage_costs_one_record():
    _, frames = archive([bytes([65 + k]) * 50 + random.Random(k).randbytes(2_000) for k in range(5)])
    whole = b"".join(frames)
    assert [e for _, _, e in warc_archive.records(memoryview(whole))] == [None] * 5
    broken = bytearray(whole)
    broken[len(frames[0]) + len(frames[1]) - 300] ^= 0xFF  # inside the second record's content
    errors = [e for _, _, e in warc_archive.records(memoryview(broken))]
    assert errors[0] is None and errors[1].startswith("frame:") and errors[2:] == [None] * 3
    cut = list(warc_archive.records(memoryview(whole[:-10])))
    assert len(cut) == 5 and cut[-1][2] == "truncated frame"
    tail = list(warc_archive.records(memoryview(whole + b"not zstd")))
    assert len(tail) == 6 and tail[-1][2] == "not a frame"
    skipped = list(warc_archive.records(memoryview(frames[0] + struct.pack("<II", 0x184D2A53, 3) + b"abc" + frames[1])))
    assert [e for _, _, e in skipped] == [None, None]


@pytest.mark.parametrize(("old", "new", "error"), [
    (b"WARC/1.1", b"WARC/9.9", "no version line"), (b"WARC-Date: ", b"WARC-When: ", "no header warc-date"), (b"\r\n\r\n", b"\r\n", "no end of headers"),
    (b"msgtype=response\r\nContent-Length: ", b"msgtype=response\r\nContent-Length: 1", "block is not as long as content-length"),
    (b"HTTP/1.1 200", b"HTTP/1.1 404", "block digest does not match"), (b"\r\nWARC-Type", b"\r\nno colon\r\nWARC-Type", "header line without a name")])
def test_records_are_validated(old, new, error):
    made, _ = archive([b"hello"])
    assert warc_archive.parse_record(made[0])["payload"] == b"hello"
    with pytest.raises(ValueError, match=re.escape(error)):
        warc_archive.parse_record(made[0].replace(old, new) if old != b"\r\n\r\n" else made[0].replace(old, new))


def test_lengths_and_digests_of_payloads_are_validated():
    made, _ = archive([b"hello"])
    block = made[0].replace(b"WARC-Block-Digest", b"X-Digest")
    with pytest.raises(ValueError, match="payload digest"):
        warc_archive.parse_record(block.replace(b"hello", b"hullo"))
    with pytest.raises(ValueError, match="HTTP content-length"):
        warc_archive.parse_record(block.replace(b"Content-Length: 5\r\n", b"Content-Length: 6\r\n"))
