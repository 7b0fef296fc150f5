"""Near-duplicates, decontamination, packing, sharding, chat formatting, personal data, pipeline parts."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.common import ALNUM, TEXTS, WORD, awkward, empty, low
from tidewatch.llm import chat_format, chosen_path, components, drop_rows, fm_decontam, fm_index, tokens, vector_packing, virtual_slots, weak_pii


# --- near-duplicates

def brute_components(rows, width, num, den):
    sets = {}
    for i, t in rows:
        w = WORD.findall(low(t or ""))
        k = min(width, len(w))
        sets.setdefault(i, []).append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if k else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in ids}


def near_copies(seed=0, n_base=6, copies=30, length=120):
    rng, rows = random.Random(seed), []
    shared = [f"s{i}" for i in range(40)]  # a passage that many different texts hold
    for b in range(n_base):
        base = [f"w{rng.randrange(400)}" for _ in range(length)]
        for _ in range(copies if b < 2 else 5):
            t = list(base)
            for _ in range(rng.randrange(0, 5)):
                t[rng.randrange(length)] = f"e{rng.randrange(9999)}"
            rows.append(" ".join(t))
    for _ in range(60):
        rows.append(" ".join(shared + [f"u{rng.randrange(99999)}" for _ in range(60)]))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize(("width", "num", "leaf", "depth"), [(3, 85, 64, 3), (5, 80, 2, 2), (3, 85, 1, 1)])
def test_components_match_brute_force(spark, width, num, leaf, depth):
    rows = near_copies()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in chosen_path.near_duplicates(docs, width=width, num=num, leaf=leaf, depth=depth).collect()}
    assert got == brute_components(rows, width, num, 100)


def test_near_duplicates_awkward_rows(spark):
    got = chosen_path.near_duplicates(awkward(spark), width=3, num=85).collect()
    assert len(got) == len(TEXTS) + 3
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    want = brute_components(list(enumerate(TEXTS)), 3, 85, 100)
    assert {k: r.component_id for k, r in by.items()} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in by.values())
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    assert by[0].n_shingles == by[1].n_shingles == by[2].n_shingles == 0
    assert chosen_path.near_duplicates(empty(spark)).count() == 0
    rest = drop_rows.one_of_each(awkward(spark), chosen_path.near_duplicates(awkward(spark), width=3, num=85))
    assert sorted(r.doc_id for r in rest.collect() if r.doc_id is not None) == sorted(k for k, v in want.items() if k == v)
    assert rest.where("doc_id is null").count() == 2


def test_rows_sharing_an_id_are_one_document(spark):
    a, b = " ".join(f"a{i}" for i in range(50)), " ".join(f"b{i}" for i in range(50))
    docs = spark.createDataFrame([(3, a), (7, a), (7, b), (9, b)], "doc_id long, text string")
    assert {r.component_id for r in chosen_path.near_duplicates(docs).collect()} == {3}


def test_connected_components_on_paths_and_cliques(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100 + i, 100 + j) for i in range(6) for j in range(i)] + [(200, 300)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in components.connected(df).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(6)}, 200: 200, 300: 200}
    assert components.connected(df.limit(0)).count() == 0


@pytest.mark.parametrize(("left", "right"), [(0, 1), (1, 1), (40, 300), (300, 340), (2000, 5000), (20000, 30000)])
def test_parity_bitmaps_never_exceed_the_difference_of_two_sets(left, right):
    rng = np.random.default_rng(left + right)
    pool = rng.integers(0, 2**63, left + right, dtype=np.uint64)
    for shared in (0, left // 2, left):
        x, y = np.unique(pool[:left]), np.unique(pool[left - shared: left - shared + right])
        p, q = (chosen_path._parity(v)[None, :] for v in (x, y))
        for size in (64, min(p.shape[1], q.shape[1])):
            far = int(np.bitwise_count(chosen_path._folded(p, size) ^ chosen_path._folded(q, size)).sum())
            assert far <= len(np.setxor1d(x, y))
            assert x.tolist() != y.tolist() or far == 0


def test_meeting_probability():
    assert chosen_path.meeting_probability(0.85, 0.85, 1) == pytest.approx(0.632, abs=1e-3)
    assert (1 - chosen_path.meeting_probability(0.85, 0.85, 3)) ** 24 < 3e-5


def test_pairs_of_a_node_are_similar_enough(spark):
    """A node of texts that share two thirds of their shingles makes few rows, and no near copy is lost."""
    g = np.random.default_rng(5)
    base = [f"w{i}" for i in range(140)]
    texts = []
    for k in range(48):
        words = list(base)
        for i in range(0, 140, 20):
            words[i + int(g.integers(0, 14))] = f"x{k}_{i}"
        texts.append(words)
    near = [[*words[:-1], "end"] for words in texts[:6]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(texts + near)], "doc_id long, text string")
    join = chosen_path._Join(docs, "doc_id", "text", 3, 85, 100, 24, 64, 3)
    rep = {r.cid: r.rep for r in join.classes.select("cid", "rep").collect()}
    got = {tuple(sorted((rep[r.a], rep[r.b]))) for r in join.pairs(join.opened(join.members("nodes"))).collect()}
    assert {(i, 48 + i) for i in range(6)} <= got
    assert len(got) < 54 * 53 // 2 // 4


def test_frequency_of_tokens_joins_nothing(spark):
    rows = spark.createDataFrame([(t, c) for c in range(9) for t in range(c)], "token long, cid long")
    found = chosen_path.with_frequency(rows)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 36 and all(r.f == 8 - r.token for r in found.collect())


# --- decontamination

@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=120), st.integers(1, 4), st.integers(1, 8))
def test_fm_index_finds_what_a_scan_finds(seq, m, sample):
    seq = np.array([*seq, 0])
    index = fm_index.FMIndex(seq, 4, sample)
    phrases = np.array([[(k + j * 2) % 3 + 1 for j in range(m)] for k in range(3)])
    lo, hi = index.search(phrases)
    for p, a, b in zip(phrases, lo, hi, strict=True):
        want = [i for i in range(len(seq) - m + 1) if (seq[i:i + m] == p).all()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_wavelet_matrix():
    seq = np.random.default_rng(1).integers(0, 11, 300)
    w = fm_index.WaveletMatrix(seq, 4)
    assert (w.access(np.arange(300)) == seq).all()
    for s in range(11):
        assert (w.rank(np.full(301, s), np.arange(301)) == np.r_[0, np.cumsum(seq == s)]).all()


def brute_hits(text, items, width=13):
    w, hit, ids = ALNUM.findall(low(text or "")), set(), set()
    for k, t in items:
        b = ALNUM.findall(low(t or ""))
        n = min(width, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == b[i:i + n]:
                    hit.update(range(j, j + n))
                    ids.add(str(k))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()


def test_contamination_matches_brute_force(spark):
    rng = random.Random(5)
    vocab = [f"v{i}" for i in range(12)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([3, 8, 13, 20, 30])))) for k in range(25)]
    items += [(90, None), (91, "..."), (92, items[0][1]), (0, items[0][1]), (93, "Shört Ünique Ïtem")]
    rows = []
    for i in range(60):
        t = [rng.choice(vocab + ["zz"]) for _ in range(rng.randrange(5, 80))]
        if i % 2:
            at = rng.randrange(len(t))
            t[at:at] = rng.choice(items[:25])[1].upper().split()
        rows.append((i, ("! " if i % 3 else " ").join(t)))
    rows += [(100, "shört, ünique ïtem"), (101, None), (102, ""), (103, rows[1][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_words", F.lit("clash")).withColumn("start", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(0))
    want = {i: brute_hits(t, items) for i, t in rows}
    for block in (1000, 7):
        found = fm_decontam.find_contamination(docs, bench, shard_bytes=500, block_items=block)
        got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in fm_decontam.verdicts(found).collect()}
        assert got == want
    cleaned = {r.doc_id: r.text for r in fm_decontam.remove_spans(found).collect()}
    for i, t in rows:
        kept = [w for k, w in enumerate(ALNUM.findall(low(t or ""))) if k not in _hit_words(t, items)]
        assert ALNUM.findall(low(cleaned[i] or "")) == kept
    assert fm_decontam.find_contamination(docs.limit(0), bench).count() == 0
    assert fm_decontam.verdicts(fm_decontam.find_contamination(docs, bench.limit(0))).where("n_hit > 0 or contaminated").count() == 0


def _hit_words(text, items):
    w, hit = ALNUM.findall(low(text or "")), set()
    for _, t in items:
        b = ALNUM.findall(low(t or ""))
        n = min(13, len(b))
        for i in range(len(b) - n + 1 if n else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == b[i:i + n]:
                    hit.update(range(j, j + n))
    return hit


# --- packing

def test_both_libraries_give_the_same_ids():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokens.tokenizer_path())
    plain.encode_special_tokens = True
    texts = [t or "" for t in TEXTS] + [" a", "a ", "  a  b\t\tc \r\n d", "x\x1fy \x1c z", "we'll  'll ' s", "1 22 333 a1b2 !? ?!"]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert tokens.Encoder(tokens.tokenizer_path()).encode(texts) == want
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column(0).to_pylist()[:300]
    want = [np.array(e.ids, "<u4").tobytes() for e in plain.encode_batch(texts, add_special_tokens=False)]
    assert tokens.Encoder(tokens.tokenizer_path()).encode(texts) == want


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.characters(max_codepoint=0x24F), st.sampled_from(" \n\t'sSlL.…—€é漢\u3000")), max_size=40))
def test_any_latin_text_has_the_same_ids(text):
    made = tokens.encoder(tokens.tokenizer_path())
    assert made.encode([text]) == [np.array(made.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()]


def test_encoder_goes_with_its_task(spark):
    """Nothing of the tokenizer stays in a worker between tasks, and Latin texts do not load the library's own."""
    made = tokens.Encoder(tokens.tokenizer_path())
    made.encode(["Plain text."])
    assert "tokenizer" not in vars(made)
    vector_packing.pack(awkward(spark), max_tokens=256, max_segments=6).count()

    def kept(batches):
        from tidewatch.llm.tokens import encoder

        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [encoder.cache_info().currsize]})

    assert {r.n for r in spark.range(64).repartition(16).mapInArrow(kept, "n long").collect()} == {0}


def test_packing_round_trip(spark):
    got = vector_packing.pack(awkward(spark), max_tokens=256, max_segments=6).collect()
    encoder = tokens.Encoder(tokens.tokenizer_path())
    end = np.array([1], "<u4").tobytes()
    want = sorted(x + end for x in encoder.encode([t or "" for t in [*TEXTS, TEXTS[5], "no id", None]]))
    docs = collections.defaultdict(list)
    for r in got:
        assert r.length == len(r.ids) // 4 <= 256 and r.ids_crc32 == zlib.crc32(r.ids) and r.loss_tokens == r.length
        docs[r.doc_id].append(r)
    rebuilt = []
    for pieces in docs.values():
        pieces.sort(key=lambda r: r.start)
        waiting = collections.defaultdict(list)  # rows that share an id
        for r in pieces:
            waiting[r.start].append(r)
        for first in waiting[0]:
            ids, at = first.ids, first.length
            while at < first.doc_tokens:
                piece = next(p for p in waiting[at] if p.doc_tokens == first.doc_tokens)
                waiting[at].remove(piece)
                ids, at = ids + piece.ids, at + piece.length
            rebuilt.append(bytes(ids))
    assert sorted(rebuilt) == want
    for _, seq in _by(got, "sequence_id"):
        seq.sort(key=lambda r: r.offset)
        assert [r.offset for r in seq] == [0, *np.cumsum([r.length for r in seq])[:-1]]
        assert sum(r.length for r in seq) <= 256 and len(seq) <= 6
    assert vector_packing.pack(empty(spark)).count() == 0


def _by(rows, name):
    out = collections.defaultdict(list)
    for r in rows:
        out[r[name]].append(r)
    return out.items()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 100), st.integers(0, 100)), min_size=1, max_size=60))
def test_bins_keep_every_limit(items):
    demand = np.array([(t, 1, min(t, n)) for t, n in items])
    limits = np.array([100, 5, 100])
    bins = vector_packing.dot_product_bins(demand, limits)
    assert sorted(i for b in bins for i in b) == list(range(len(items)))
    assert all((demand[b].sum(0) <= limits).all() for b in bins)


def test_loss_limit_cuts_pieces(spark):
    docs = spark.createDataFrame([(i, "alpha beta gamma " * (i + 1), 2 * i) for i in range(40)], "doc_id long, text string, answer long")
    got = vector_packing.pack(docs, loss="answer", max_tokens=64, max_segments=4, max_loss=16).collect()
    for _, seq in _by(got, "sequence_id"):
        assert sum(r.length for r in seq) <= 64 and len(seq) <= 4 and sum(r.loss_tokens for r in seq) <= 16
    for i, pieces in _by(got, "doc_id"):
        assert sum(r.length for r in pieces) == pieces[0].doc_tokens
        assert sum(r.loss_tokens for r in pieces) == min(2 * i, pieces[0].doc_tokens)


# --- sharding

def test_shards_are_even_gapless_and_grow_into_the_new_one(spark, tmp_path):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(pmod(hash(id), 300) as int))").alias("text"))
    placed, slot_map, sizes = virtual_slots.shard_documents(docs, 8, n_slots=512)
    rows = placed.collect()
    loads = collections.Counter()
    for _, seq in _by(rows, "shard"):
        assert sorted(r.position for r in seq) == list(range(len(seq)))
        loads[seq[0].shard] = sum(r.size for r in seq)
    assert len(loads) == 8 and max(loads.values()) <= 1.01 * min(loads.values())
    path = str(tmp_path / "maps")
    virtual_slots.store_map(slot_map, path)
    virtual_slots.store_map(virtual_slots.grow_map(virtual_slots.load_map(spark, path), sizes, 8), path)
    old = {r.vslot: r.shard for r in virtual_slots.load_map(spark, path, 1).collect()}
    new = {r.vslot: r.shard for r in virtual_slots.load_map(spark, path).collect()}
    assert len(old) == len(new) == 512
    assert all(new[v] in (old[v], 8) for v in old)
    grown = collections.Counter()
    for r in rows:
        grown[new[r.vslot]] += r.size
    assert len(grown) == 9 and max(grown.values()) <= 1.25 * min(grown.values())


def test_sharding_awkward_rows(spark):
    placed, _, _ = virtual_slots.shard_documents(awkward(spark), 5, n_slots=64)
    rows = placed.collect()
    assert sorted((r.size, r.text_crc32) for r in rows) == sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for t in [*TEXTS, TEXTS[5], "no id", None])
    for _, seq in _by(rows, "shard"):
        assert sorted(r.position for r in seq) == list(range(len(seq)))
    placed, slot_map, _ = virtual_slots.shard_documents(empty(spark), 5, n_slots=64)
    assert placed.count() == 0 and slot_map.groupBy("shard").count().count() == 5


# --- chat

HOSTILE = st.lists(st.sampled_from(["[INST]", "[/INST]", "</s>", "<s>", "<<SYS>>", "\n<</SYS>>\n", "[OUT] ", "[ROLE]", "[/ROLE]", "\\", "\\\\", "[", "<", "/", "a", " ", "\n", "é漢"]),
                   max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "", "tool\n[/ROLE]\\"]), HOSTILE), max_size=6))
def test_formatted_conversations_read_back(turns):
    made = chat_format.Formatter(chat_format.Template())
    text, segments = made.render(turns)
    assert list(made.parse(text)) == turns
    assert [s[0] for s in segments[1:]] == [s[1] for s in segments[:-1]] and (not segments or segments[-1][1] == len(text))
    assert "".join(made.unescape(text[a:b]) for a, b, loss, _ in segments if loss) == "".join(t for r, t in turns if r == "assistant")


def test_role_machine():
    check = chat_format.Formatter(chat_format.Template()).check
    assert check(["system", "user", "assistant", "user", "assistant"]) == (True, 0)
    assert check(["user"]) == (True, 0)
    assert check([]) == (False, 0)
    assert check(["assistant", "user", "user", "tool"]) == (False, 3)


def test_chat_awkward_rows(spark):
    rows = [(1, 1, "user", "q"), (1, 2, "assistant", "</s>"), (None, None, None, None), (2, 5, "user", "x"), (2, 5, "user", "x"), (2, 1, "system", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("conv", F.lit(0)).withColumn("formatted", F.lit(1))
    got = {r.conv_id: r for r in chat_format.read_back(chat_format.format_conversations(turns)).collect()}
    assert got[1].turns_sha256 == hashlib.sha256(b"user\nq\nassistant\n</s>\n").hexdigest() and got[1].valid and got[1].loss_chars == 4
    assert got[2].turns_sha256 == hashlib.sha256(b"system\n\nuser\nx\nuser\nx\n").hexdigest() and not got[2].valid
    assert got[None].n_turns == 1 and got[None].turns_sha256 == hashlib.sha256(b"\n\n").hexdigest()
    assert chat_format.format_conversations(turns.limit(0)).count() == 0


def test_long_conversations_are_many_rows(spark):
    rng = random.Random(4)
    said = [(rng.choice(["user", "assistant", "system", "odd"]), rng.choice(["</s>", "é [INST]", ""]) + "x" * rng.randrange(60)) for _ in range(400)]
    rows = [(c, i // 2, r, t) for c in (None, 7) for i, (r, t) in enumerate(said)] + [(1, 0, "user", "q"), (1, 1, "assistant", "a")]
    turns = spark.createDataFrame(rows + [(7, 5, "user", "same")] * 50, "conv_id long, turn long, role string, text string").repartition(6)
    pieces = chat_format.format_conversations(turns, piece_chars=500)
    got = sorted(pieces.collect(), key=lambda r: (str(r.conv_id), r.part, r.piece))
    digests = {r.conv_id: r for r in chat_format.read_back(pieces).collect()}
    made = chat_format.Formatter(chat_format.Template())
    assert set(digests) == {None, 7, 1}
    for c in digests:
        want = [x[2:] for x in sorted([*rows, *[(7, 5, "user", "same")] * 50], key=lambda x: x[1:]) if x[0] == c]
        formatted, segments = made.render(want)
        mine = [r for r in got if r.conv_id == c]
        assert "".join(r.formatted for r in mine) == formatted and [tuple(s) for r in mine for s in r.segments] == segments
        assert (mine[-1].valid, mine[-1].wrong_steps) == made.check([r for r, _ in want]) and mine[-1].n_turns == len(want)
        assert max(len(r.formatted) for r in mine) < 2_000 and (c == 1 or len(mine) > 5)
        assert digests[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in want).encode()).hexdigest()
        masked = "".join(t for r, t in want if r == "assistant")
        assert digests[c].loss_sha256 == hashlib.sha256(masked.encode()).hexdigest() and digests[c].loss_chars == len(masked)
        assert digests[c].formatted_chars == len(formatted) and digests[c].valid == mine[-1].valid


# --- personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def brute_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")), "card": lambda: 14 <= len(d) <= 19 and luhn(d),  # noqa: B023
                  "phone": lambda: 10 <= len(d) <= 15}[kind]()
            if ok:
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def test_base_spans_match_brute_force(spark):
    rng = random.Random(2)
    bits = ["a@b.co", "x.y@z-w.org.", "@", "..", "1.2.3.4", "300.1.1.1", ".5", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (743) 555-3824", "+49", " 7", "é", "漢 ", "-", "\n", "9" * 15, "_c", "%", "+"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randrange(1, 14)))) for i in range(400)]
    rows += list(enumerate(TEXTS, 1000)) + [(2000, "9" * 3_000), (2001, "a." * 1_500 + "@"), (2002, "1-" * 2_000), (2003, "+1" + " " * 20_000)]
    found, _ = weak_pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"])
    got = {r.doc_id: [tuple(s) for s in r.base] for r in found.collect()}
    assert got == {i: brute_spans(t) for i, t in rows}


def test_weak_supervision_adds_and_masks(spark):
    rng = random.Random(4)
    rows = []
    for i in range(200):
        secret = "".join(rng.choice("0123456789abcdef") for _ in range(40))
        rows.append((i, [f"the token = \"{secret}\" is", f"mail a{i}@b.org or 10.0.0.{i % 250}", f"ssn: {rng.randrange(100, 600)}-{rng.randrange(10, 99)}-{rng.randrange(1000, 9999)} now",
                         "nothing_but_some_long_words_here2 of prose"][i % 4]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("raw", F.lit(2))
    masked = {r.doc_id: r for r in weak_pii.mask_documents(docs).collect()}
    assert masked[0].text == 'the token = "[SECRET]" is' and masked[0].spans == 1
    assert masked[1].text == "mail [EMAIL] or [IP]"
    assert masked[2].text == "ssn: [NATIONAL_ID] now"
    assert masked[3].text == rows[3][1]
    assert weak_pii.mask_documents(awkward(spark)).where("text is null").count() == 2
    found, model = weak_pii.find_pii(empty(spark), ["doc_id"])
    assert found.count() == 0 and not model.weights


def test_reliabilities_follow_the_votes():
    rows = []
    for truth, n in ((1, 300), (0, 700)):
        rng = random.Random(truth)
        for _ in range(n):
            vote = lambda right: (1 if truth else -1) if rng.random() < right else (-1 if truth else 1)  # noqa: E731, B023
            rows.append({"n": 1, **dict.fromkeys(weak_pii.FEATURES, "x"), "size": "12" if truth else "40",
                         "format": vote(0.95), "checksum": vote(0.9), "gazetteer": vote(0.85), "context": vote(0.8), "shape": rng.choice([-1, 1])})
    model = weak_pii.SpanModel(rows, steps=50)
    right = {v: model.reliability[v][1][0] for v in weak_pii.VOTES}
    assert right["format"] > 0.85 and right["context"] > 0.7 and abs(right["shape"] - 0.5) < 0.1
    assert model.prior == pytest.approx(0.3, abs=0.05)
    assert model.weights["size=12"] > model.weights["size=40"]


def test_pipeline_keeps_columns_and_drops_copies(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    pieces = corpus_pipeline.run(spark, d)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
    kept = corpus_pipeline.quality(spark, docs, d)
    assert kept.schema == docs.schema and 0 < kept.count() < docs.count()
    for stage in (corpus_pipeline.near_dedup, corpus_pipeline.decontaminate, corpus_pipeline.mask_pii):
        kept = stage(spark, kept, d)
        assert kept.columns == docs.columns
