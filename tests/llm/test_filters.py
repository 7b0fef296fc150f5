"""URL reputation, adaptive rules, quality classifier, language-model scores."""

import collections
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.common import TEXTS, WORD, awkward, empty, low
from tidewatch.llm import adaptive_rules, attention_mil, deleted_interpolation, url_reputation


def test_url_host_path_rules(spark):
    urls = [(1, "HTTP://A.Example.NET/en/x?q#f"), (2, "http://example.net"), (3, "nothing"), (4, None), (5, "x://b.org/fr/"),
            (6, "x://b.org?/fr/"), (7, "s://u://v/w"), (None, "x://h.com/de/1"), (8, "x://sub.example.com/de/1"), (9, "x://notexample.com/de/1")]
    rules = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
    pages = spark.createDataFrame(urls, "page_id long, url string").withColumn("host", F.lit("clash"))
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.filter_urls(pages, none, rules).collect()}
    assert got == {1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("example.net", "", None, "allow"), 3: ("", "", None, "allow"),
                   4: ("", "", None, "allow"), 5: ("b.org", "/fr/", "org/fr/", "allow"), 6: ("b.org", "", None, "allow"), 7: ("u:", "//v/w", None, "allow"),
                   None: ("h.com", "/de/1", None, "allow"), 8: ("sub.example.com", "/de/1", "example.com/de/", "block"),
                   9: ("notexample.com", "/de/1", None, "allow")}
    assert url_reputation.filter_urls(pages.limit(0), none, rules).count() == 0


def test_url_reputation_blocks_bad_hosts_and_shrinks(spark):
    rows, labels, k = [], [], 0
    for host, n, bad in (("bad.spam.com", 60, 58), ("new.spam.com", 1, 1), ("unseen.spam.com", 1, None), ("ok.fine.org", 80, 2), ("one.fine.org", 1, 1), ("z.else.net", 40, 3)):
        for i in range(n):
            rows.append((k, f"http://{host}/p"))
            if bad is not None:
                labels.append((k, int(i < bad)))
            k += 1
    pages, marks = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(labels, "page_id long, bad int")
    got = {r.host: r for r in url_reputation.filter_urls(pages, marks).dropDuplicates(["host"]).collect()}
    assert got["bad.spam.com"].verdict == "block" and got["ok.fine.org"].verdict == "allow"
    assert got["one.fine.org"].verdict == "allow"  # one bad page does not outweigh its domain
    assert got["new.spam.com"].posterior > got["one.fine.org"].posterior
    assert got["unseen.spam.com"].posterior > got["z.else.net"].posterior


def test_url_query_matches_its_sql(spark):
    from oracle_check import compare, duck

    from tidewatch.llm import queries

    d = "/root/testdata/sf0.01"
    status, message = compare("op1_url_reputation", queries.QUERIES["op1_url_reputation"](spark, d), duck(d), queries.ORACLE["op1_url_reputation"])
    assert status == "OK", message


def brute_counts(t):
    t = t or ""
    w, seen, dup = WORD.findall(t), set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    c = collections.Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = np.zeros(len(w), bool)
    for i in range(len(w) - 7):
        if c[tuple(w[i:i + 8])] > 1:
            hit[i:i + 8] = True
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), dup, int(hit.sum())


def test_rule_counts_match_brute_force(spark):
    got = sorted((r.text or "", tuple(r[c] for c in adaptive_rules.COUNTS)) for r in adaptive_rules.measure(awkward(spark), ["doc_id", "text"]).collect())
    want = sorted((t or "", brute_counts(t)) for t in [*TEXTS, TEXTS[5], "no id", None])
    assert got == want


def test_rules_adapt_to_groups(spark):
    clean = [(i, " ".join(f"word{(i * 7 + j) % 83}" for j in range(60)), "en", "a") for i in range(80)]
    table = [(100 + i, " | ".join(f"cell{(i * 5 + j) % 79}" for j in range(60)), "en", "tables") for i in range(80)]
    odd = [(300, clean[0][1].replace(" ", "### "), "en", "a"), (301, None, None, None)]
    docs = spark.createDataFrame(clean + table + odd, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in adaptive_rules.judge(docs, ["doc_id"], ["lang", "source"]).collect()}
    assert all(got[d[0]].kept for d in clean + table)  # symbols are usual in one source, odd in the other
    assert not got[300].kept and got[300].failed_rules == ["symbols"]
    assert got[301].base_failed and not got[301].kept
    assert adaptive_rules.judge(docs.limit(0), ["doc_id"], ["lang", "source"]).count() == 0


def test_repetition_below_the_base_limit_is_judged_by_its_group(spark):
    def text(i, n, copies):
        """``n`` lines of 20 words, of which one line takes ``copies``."""
        line = lambda k: " ".join(f"w{i}x{k}x{j}" for j in range(20))
        return "\n".join([line(0)] * copies + [line(k) for k in range(1, n - copies + 1)])

    rows = [(i, text(i, 20, 1), "en", "clean") for i in range(80)]
    rows += [(100 + i, text(100 + i, 20, 2 + i % 5), "en", "repetitive") for i in range(80)]
    # 25 % of the words in repeats, 20 % of the lines copies
    rows += [(300, text(300, 20, 5), "en", "clean"), (301, text(301, 20, 5), "en", "repetitive")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r for r in adaptive_rules.judge(docs, ["doc_id"], ["lang", "source"]).collect()}
    assert not got[300].base_failed and not got[301].base_failed
    assert not got[300].kept and got[300].failed_rules == ["dup_lines", "repeats"]
    assert all(r.kept for k, r in got.items() if k != 300)


def bags(rng, n):
    xs, ys = [], []
    for _ in range(n):
        y = int(rng.integers(2))
        x = rng.normal(size=(int(rng.integers(1, 8)), 5))
        if y:
            x[rng.integers(len(x)), 0] += 5  # one telling passage
        xs.append(x)
        ys.append(y)
    return np.concatenate(xs), np.r_[0, np.cumsum([len(x) for x in xs])], np.array(ys, float)


def test_attention_gradient_and_accuracy():
    rng = np.random.default_rng(3)
    x, bag, y = bags(rng, 30)
    model = attention_mil.Model(5)
    loss = lambda: float(-(y * np.log(model.forward(x, bag)[0]) + (1 - y) * np.log(1 - model.forward(x, bag)[0])).sum())
    p, f = model.forward(x, bag)
    for name, g in model.gradient(f, bag, p - y).items():
        at = tuple(0 for _ in g.shape)
        old = model.p[name][at]
        model.p[name][at] = old + 1e-5
        up = loss()
        model.p[name][at] = old - 1e-5
        assert (up - loss()) / 2e-5 == pytest.approx(g[at], abs=1e-3)
        model.p[name][at] = old
    x, bag, y = bags(rng, 400)
    model.fit(x, bag, y)
    x, bag, y = bags(rng, 400)
    p, f = model.forward(x, bag)
    assert ((p >= 0.5) == y).mean() > 0.9
    assert np.allclose(np.add.reduceat(f["a"], bag[:-1]), 1)


def test_quality_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    scored = attention_mil.score(docs.select("doc_id", "text"), attention_mil.fit(docs, labels))
    held = scored.where(~attention_mil.learnable("doc_id")).join(labels, "doc_id").toPandas()
    assert ((held.score >= 0.5) == held.quality).mean() > 0.95


def test_quality_awkward_rows(spark):
    labels = spark.createDataFrame([(0, 1), (1, 0), (None, 1), (3, None)], "doc_id long, quality int")
    model = attention_mil.fit(awkward(spark), labels)
    got = attention_mil.score(awkward(spark), model, out="mil").collect()
    assert len(got) == len(TEXTS) + 3 and all(0 <= r.mil <= 1 for r in got)
    assert attention_mil.score(empty(spark), 0.5, out="mil").count() == 0
    assert attention_mil.fit(awkward(spark), labels.limit(0)) == 0.5


def brute_base(rows):
    tokens = [[*WORD.findall(low(t or "")), "\n"] for _, t in rows]
    train = [i is not None and zlib.crc32(str(i).encode()) % 7 != 2 for i, _ in rows]
    c = collections.Counter(w for ws, f in zip(tokens, train, strict=True) if f for w in ws)
    n, v = sum(c.values()), len(c)
    return [(len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for ws in tokens], c


def test_lm_totals_beyond_32_bits(spark):
    squeeze = deleted_interpolation._squeeze
    keys, counts = squeeze(np.array([5, 4], dtype="<u8")), squeeze(np.array([3_000_000_000, 1], dtype="<u4"))  # keys as differences
    sent = spark.createDataFrame([(0, 1, c, keys, counts) for c in (1, 2)], "bucket int, size int, chunk long, keys binary, counts binary")
    got = deleted_interpolation._added(sent).collect()
    assert sorted(r.tokens for r in got if r.chunk is None) == [6_000_000_002]
    for r in got:
        if r.chunk is not None:
            one, context, two = deleted_interpolation._counts(r.totals, r.totals, 7)
            assert one.tolist() == two.tolist() == [6_000_000_000, 2] and context.tolist() == [7, 6_000_000_000]


def test_lm_counts_and_model(spark, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[5]), (None, "no id"), (None, None)]
    train = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 7 != 2
    scored, model = deleted_interpolation.score_texts(awkward(spark), train, chunk_bytes=50_000, bucket_bytes=20_000)
    got = sorted((r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in scored.collect())
    want, counts = brute_base(rows)
    assert got == sorted((a, b, c, round(d, 6)) for a, b, c, d in want)
    assert model["types"] == len(counts) and model["tokens"] == sum(counts.values())
    assert np.allclose(model["weights"].sum(1), 1)
    scored, model = deleted_interpolation.score_texts(empty(spark), train)
    assert scored.count() == 0 and model["tokens"] == 0


def test_lm_score_is_the_mixture(spark):
    texts = ["a b a b c", "a b c", "b a b", "c c a", "a b"] * 4
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scored, model = deleted_interpolation.score_texts(docs, F.col("doc_id") < 15)
    uni, bi, ends = collections.Counter(), collections.Counter(), 15
    for t in texts[:15]:
        ws = ["$", *t.split(), "$"]
        uni.update(ws[1:])
        bi.update(zip(ws[:-1], ws[1:], strict=True))
    n, v = sum(uni.values()), len(uni)
    for r in scored.collect():
        ws, total = ["$", *texts[r.doc_id].split(), "$"], 0.0
        for a, b in zip(ws[:-1], ws[1:], strict=True):
            cv = ends if a == "$" else uni[a]
            w = model["weights"][min(31, cv.bit_length())]
            total += math.log10(w[0] * bi[a, b] / max(1, cv) + w[1] * uni[b] / n + w[2] / (v + 1))
        assert r.score == pytest.approx(total, rel=1e-9)
    assert model["weights"][5][0] > 0.3  # bigrams tell here


def test_em_weights_do_not_lower_likelihood():
    rng = np.random.default_rng(0)
    n = rng.integers(1, 50, 200).astype(float)
    level = rng.integers(0, 6, 200)
    two, one = rng.random(200) * (level > 0), rng.random(200) * 0.1
    cell = level * deleted_interpolation.CELLS**2 + np.arange(200)

    def likelihood(w):
        return float((n * np.log((w[level] * np.stack([two, one, np.full(200, 1 / 101)], 1)).sum(1))).sum())

    values = [likelihood(deleted_interpolation.learn_weights(cell, n, two * n, one * n, 100, rounds=k)) for k in (1, 5, 50)]
    assert values[0] <= values[1] + 1e-2 and values[1] <= values[2] + 1e-2
