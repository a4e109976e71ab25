"""Toxicity, quality rules, language model, personal data."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.llm import pii, quality, suffix_lm, toxicity
from quire.llm import textkit as tk

from .helpers import ODD, SF, table


def _corpus(n=600):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6))) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        w = [rng.choice(words) for _ in range(rng.randrange(20, 60))]
        bad = rng.random() < 0.15
        if bad:
            w[rng.randrange(len(w))] = rng.choice(["zidiot", "zmoron", "zscumbag"])
        docs.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    return docs, labels


def test_nnpu_on_held_out_rows(spark):
    docs, labels = _corpus()
    d, y = table(spark, docs), table(spark, [x for x in labels if x[0] % 2 == 0] + [(None, 1), (3, None)], "doc_id long, toxic int")
    m = toxicity.fit(d, y, toxicity.fold() != 1)
    assert 0.05 < m.prior < 0.35
    truth = dict(labels)
    r = toxicity.score(d, m).where(toxicity.fold() == 1).collect()
    hit = [(x["score"] >= 0.7, truth[x["doc_id"]]) for x in r]
    assert sum(p and t for p, t in hit) >= 0.8 * sum(t for _, t in hit) and sum(p and not t for p, t in hit) <= 0.05 * len(hit)


def test_rare_words_count_in_large_samples(spark):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(200)]
    docs = []
    for i in range(60000):
        w = [rng.choice(words) for _ in range(8)]
        if i < 2600:  # positive; one word is in 8 of them only
            w[3] = "zrarest" if i % 325 == 0 else "zidiot"
        docs.append((i, " ".join(w)))
    m = toxicity.fit(table(spark, docs), table(spark, [(i, 1) for i in range(2600)], "doc_id long, toxic int"))
    r = {x["doc_id"]: x["score"] for x in toxicity.score(table(spark, [(1, f"{words[0]} {words[1]} zrarest {words[2]}"), (2, f"{words[0]} {words[1]} {words[3]} {words[2]}")]), m).collect()}
    assert r[1] > r[2]


def test_risk_is_non_negative_pu():
    rng = np.random.default_rng(0)
    n = 2000
    pos = rng.random(n) < 0.3
    x = np.stack([pos & (rng.random(n) < 0.9), rng.random(n) < 0.5, np.ones(n)], axis=1).astype(np.float32)
    w, b = toxicity.train_nnpu(x[pos][:300], x, 0.3, 1)
    assert w[0] > 1.5 and w[0] > 4 * abs(w[1]) and b < 0


def test_toxicity_of_odd_rows(spark):
    y = table(spark, [], "doc_id long, toxic int")
    assert toxicity.fit(table(spark, ODD), y) is None
    r = toxicity.score(table(spark, ODD), None).collect()
    assert len(r) == len(ODD) and all(0 <= x["score"] <= 1 for x in r)
    assert toxicity.without_toxic(table(spark, ODD), None).count() == len(ODD)
    assert toxicity.score(table(spark, []), None).count() == 0


def test_statistics_against_brute_force():
    rng = random.Random(4)
    texts = ["\n".join(" ".join(rng.choice(["a", "b", "é#", "C!", "9|", "", "\t", "long.,"]) for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(0, 8))) for _ in range(200)] + ["", None, " \n\n "]
    b = pa.record_batch({"doc_id": list(range(len(texts))), "text": texts})
    got = {}
    for p in tk.pieces(b, size=200):
        s = quality.piece_stats(p)
        for k, i in enumerate(p.ids.to_pylist()):
            got[i] = [int(s[c][k]) for c in quality.COUNTS[:6]]
    for i, t in enumerate(texts):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        c = collections.Counter(zip(w, w[1:], w[2:]))
        hit = {k + x for k in range(len(w) - 2) if c[tuple(w[k : k + 3])] > 1 for x in range(3)}
        full = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert got[i] == [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(hit), len(set(w))], t


def test_decision_list():
    rng = np.random.default_rng(3)
    n = 3000
    x = {"a": rng.random(n), "b": rng.random(n), "c": rng.random(n)}
    y = (x["a"] > 0.8) | ((x["b"] < 0.2) & (x["c"] > 0.5))
    rules = quality.learn_list(x, y, np.arange(n) % 3 == 0)
    caught = np.zeros(n, bool)
    for r in rules:
        caught |= quality._covers(r.tests, x, n)
    assert (caught == y).mean() > 0.95 and all(r.precision >= 0.9 for r in rules)
    assert quality.learn_list(x, np.zeros(n, bool), np.arange(n) % 3 == 0) == []


def test_quality_of_odd_rows(spark):
    y = table(spark, [], "doc_id long, quality int")
    r = quality.judge(table(spark, ODD).selectExpr("*", "1 AS n_words", "'q' AS kept"), y).collect()
    assert len(r) == len(ODD) and all(not x["kept"] for x in r)
    assert quality.judge(table(spark, []), y).count() == 0


def _brute_lm(docs, held):
    """The model by its definition: contexts of any length, kept while they pass the test."""
    tr = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tok = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(tr)) + [None] for _, t in docs]
    learn = [t for t, h in zip(tok, held) if not h]
    ones = collections.Counter(w for t in learn for w in t)
    n, v = sum(ones.values()), len(ones)
    mu, states, counts, k = suffix_lm.MU, {}, {}, 0

    def prob(before, w):
        g, p = (), (ones[w] + 1) / (n + v + 1)
        for j in range(1, len(before) + 1):
            g = before[-j:]
            if g not in states:
                break
            p = (counts[g][w] + mu * p) / (states[g] + mu)
        return p

    while True:
        k += 1
        by = collections.defaultdict(collections.Counter)
        for t in learn:
            for j in range(k, len(t)):
                if k == 1 or tuple(t[j - k + 1 : j]) in states:
                    by[tuple(t[j - k : j])][t[j]] += 1
        new = {}
        for g, c in by.items():
            total = sum(c.values())
            if total >= suffix_lm.MIN_COUNT and sum(m * (math.log(m - 1 + mu * (p := prob(g[1:], w))) - math.log(total - 1 + mu) - math.log(p)) for w, m in c.items()) >= suffix_lm.MIN_GAIN:
                new[g] = total
        if not new:
            break
        states |= new
        counts |= {g: by[g] for g in new}
    out = []
    for t in tok:
        base = sum(math.log10((ones[w] + 1) / (n + v + 1)) for w in t)
        out.append((len(t), sum(ones[w] > 0 for w in t), n, base, sum(math.log10(prob(tuple(t[:j]), w)) for j, w in enumerate(t))))
    return out, k - 1


def _lm_corpus():
    rng = random.Random(2)
    docs = []
    for i in range(240):
        w = [rng.choice("abcdefghij")]
        for _ in range(rng.randrange(0, 60)):
            w.append(chr(ord("a") + (ord(w[-1]) - 96 + (0 if rng.random() < 0.7 else rng.randrange(10))) % 10))
        docs.append((i, " ".join(w) + (" Rare%d" % i if i % 9 == 0 else "")))
    for i in range(240, 400):  # what ends a run of seven is told by what begins it
        docs.append((i, " ".join(f"{'AC'[x]} {'x ' * 7}{'BD'[x]} " + " ".join(rng.choice("mnop") for _ in range(rng.randrange(3))) for x in (rng.randrange(2) for _ in range(5)))))
    return docs + [(None, "a b"), (400, None), (401, ""), (402, docs[250][1]), (402, docs[250][1])]


@pytest.mark.parametrize("hot", [suffix_lm.HOT, 25])
def test_suffix_tree_against_brute_force(spark, hot, monkeypatch):
    docs = _lm_corpus()
    monkeypatch.setattr(suffix_lm, "EXTRA", (0, 0, 2, 1) if hot == 25 else (0, 0, 4, 12))
    monkeypatch.setattr(suffix_lm, "PART_BYTES", 3000)
    held = [i is None or zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs]
    want, depth = _brute_lm(docs, held)
    assert depth >= 8
    got = suffix_lm.suffix_tree_scores(table(spark, docs).selectExpr("*", "1 AS part", "2 AS train"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2, hot=hot).collect()
    assert len(got) == len(docs)
    row = lambda i, h, x: (str(i), h, *x[:3])
    told = sorted((row(i, h, x) + x[3:] for (i, _), h, x in zip(docs, held, want)), key=lambda r: (r[:5], -r[6]))
    found = sorted((row(x["doc_id"], x["held_out"], (x["n_tokens"], x["n_known"], x["train_tokens"])) + (x["base_score"], x["score"]) for x in got), key=lambda r: (r[:5], -r[6]))
    for a, b in zip(told, found):
        assert a[:5] == b[:5] and math.isclose(a[5], b[5], rel_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-6), (a, b)
    out = [(b, s) for h, (*_, b, s) in zip(held, want) if h]
    assert sum(s for _, s in out) > sum(b for b, _ in out)  # better on what it has not seen


def test_suffix_tree_of_nothing(spark):
    assert suffix_lm.suffix_tree_scores(table(spark, []), F.lit(False)).count() == 0
    r = suffix_lm.suffix_tree_scores(table(spark, ODD), F.lit(True)).collect()  # all held out
    assert len(r) == len(ODD) and all(x["train_tokens"] == 0 and x["score"] == x["base_score"] == 0 for x in r)


def test_frequent_contexts_are_tested_with_exact_probabilities(spark):
    kept = set()
    for n, skew in ((11, 0.0), (7, 0.06)):  # of equal next words, and of a little different ones
        rng = random.Random(n)
        docs = []
        for i in range(40):
            w = [rng.randrange(n)]
            for _ in range(800):
                w.append((w[-1] + 1) % n if rng.random() < skew else rng.randrange(n))
            docs.append((i, " ".join(f"w{x}" for x in w)))
        want, depth = _brute_lm(docs, [False] * len(docs))
        kept.add(depth)
        got = {x["doc_id"]: x["score"] for x in suffix_lm.suffix_tree_scores(table(spark, docs), F.lit(False), hot=20 if n == 7 else suffix_lm.HOT).collect()}
        assert all(math.isclose(got[i], x[4], rel_tol=1e-7) for (i, _), x in zip(docs, want))
    assert min(kept) == 0 and max(kept) > 0


def test_next_words_with_like_hashes_stay_apart():
    rows = [dict(bucket=0, part=0, spread=0, ctx=np.array([7], "u8").tobytes(), run=suffix_lm._planes(np.array([2], "<u4")), total=b"", w=suffix_lm._words(np.array([5, 5 + (1 << 32)], np.uint64), True), x=b"", p=suffix_lm._planes(np.array([0.2, 0.3], "<f4")), **suffix_lm._counts(np.array([9, 4])))]
    back = suffix_lm.test_contexts(suffix_lm._table(rows, suffix_lm.ASK), 1).to_pylist()
    assert suffix_lm._read_counts(back[0]).tolist() == [9, 4] and np.frombuffer(back[0]["total"], "i8").tolist() == [13]


def test_base_spans_against_regexes():
    rng = random.Random(6)
    bits = ["a.b@c.de", "x@y", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (499) 555-6503", "+12", "é", " ", "\n", ".", "@", "9", "-", "+49 30 123456.", "word,"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(0, 14))) for _ in range(500)]
    rs = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]
    b = pa.record_batch({"doc_id": list(range(len(texts))), "text": texts})
    for p in tk.pieces(b):
        points = np.concatenate(([0], np.cumsum((p.buf & 0xC0) != 0x80)))
        for t, got in zip(texts, pii._by_doc(p, pii.base_spans(p.buf), points)):
            want = sorted(((m.start(), m.end(), k) for k, r in enumerate(rs) for m in re.finditer(r, t) if pii.accepted(k, m.group().encode())), key=lambda s: (s[0], s[2]))
            assert got == want, t


def test_message_passing_is_exact_on_a_tree():
    rng = np.random.default_rng(1)
    n = 5
    f = pii.Field(rng.normal(size=(pii.DIM, pii.L)), np.stack([(a + a.T) / 2 for a in rng.normal(size=(3, pii.L, pii.L))]))
    z = np.zeros(n, np.int64)
    g = pii.Graph(z, z, z, z, rng.integers(0, pii.DIM, (n, 3)).astype(np.int32), [np.array([[0, 1], [1, 2]]), np.array([[1, 3]]), np.array([[3, 4]])], z)
    unary = f.node[g.features].sum(axis=1)
    exact = np.zeros((n, pii.L))
    for y in itertools.product(range(pii.L), repeat=n):
        s = sum(unary[i, y[i]] for i in range(n)) + sum(f.pair[t][y[i], y[j]] for t, e in enumerate(g.edges) for i, j in e.tolist())
        for i in range(n):
            exact[i, y[i]] += math.exp(s)
    exact /= exact.sum(axis=1, keepdims=True)
    assert np.allclose(pii.marginals(g, f, rounds=60), exact, atol=1e-6)


def _private(n=400):
    """Phones and cards among numbers that are neither; every other document has its number twice, the second time without its prefix."""
    rng = random.Random(8)
    words = [f"word{'abcdefgh'[i % 8]}{'xyz'[i % 3]}" for i in range(24)]
    noise = lambda k: " ".join(rng.choice([*words, str(rng.randrange(10, 99)), f"v{rng.randrange(9)}.{rng.randrange(9)}", f"{rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}", f"({rng.randrange(100, 999)})", f"({rng.randrange(100, 999)}) {rng.randrange(100, 999)}-{rng.randrange(1000, 9999)}"]) for _ in range(k))
    docs = []
    for i in range(n):
        num = f"({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        docs.append((i, f"{noise(20)} +1 {num} wordax {noise(30)}" + (f" +1 {num} wordby {noise(9)}" if i % 2 else "")))
    return docs


def test_the_field_adds_what_skip_edges_tell(spark):
    docs = _private()
    field = pii.fit(table(spark, docs))
    text = "worda +1 (323) 555-9830 " + "wordb " * 40 + "call (323) 555-9830, now and 555-1111 or 12 then 2.0"
    far, alone = text, "wordb " * 40 + "call (323) 555-9830, now"
    other = table(spark, [(1, far), (2, alone), (3, "éé " + far), (4, far.replace("323", "324", 1).replace("9830", "9831", 1))])
    at = text.index("call (") + 5
    r = {x["doc_id"]: x["spans"] for x in pii.find(other, field).collect()}
    assert r[1] == f"phone:6:23,phone:{at}:{at + 14}" and r[3] == f"phone:9:26,phone:{at + 3}:{at + 17}"
    off = {x["doc_id"]: x["spans"] for x in pii.find(other, pii.Field(field.node, np.zeros_like(field.pair))).collect()}
    assert off[1] == "phone:6:23" and off[2] == "" == r[2]  # nothing without the edges, and nothing without the other mention
    assert pii.redact(other.where("doc_id = 1"), field).first()["text"].count("<PHONE>") == 2


def test_hidden_spans_are_recovered(spark):
    docs = table(spark, _private())
    field = pii.fit(docs.where("doc_id < 250"))
    held = docs.where("doc_id >= 250")
    on, off = pii.recovery(held, field), pii.recovery(held, pii.Field(field.node, np.zeros_like(field.pair)))
    assert on["hidden"] > 30 and on["found"] >= 0.9 * on["hidden"] and on["right"] >= 0.8 * on["added"]  # numbers without a prefix abound here
    assert off["hidden"] == on["hidden"] and off["found"] < on["found"]


def test_numbers_that_fail_their_test_are_left_alone(spark):
    good, bad = "4111111111111111", "4111111111111112"
    assert not pii.rejected(good.encode()) and pii.rejected(bad.encode()) and pii.rejected(b"1.2.3.400") and not pii.rejected(b"1.2.3.4") and not pii.rejected(b"12")
    rng = random.Random(3)

    def card():
        n = "4" + "".join(str(rng.randrange(10)) for _ in range(14))
        return n + next(d for d in "0123456789" if pii.luhn((n + d).encode()))

    field = pii.fit(table(spark, [(i, f"some words {card()} and more words") for i in range(300)]))
    r = [x["spans"] for x in pii.find(table(spark, [(1, f"a {good} b {bad} c"), (2, f"x {bad}")]), field).orderBy("doc_id").collect()]
    assert r == ["card:2:18", ""]


def test_fit_is_bounded(spark):
    d = table(spark, _private(40))
    assert not pii.fit(d, fit_tokens=1).pair.any() and pii.fit(d, fit_docs=30).pair.any()


def test_personal_data_of_odd_rows(spark):
    docs = _private(60) + [(901, "mail a.b@c.de, 10.0.0.1!"), (902, None), (None, "a.b@c.de"), (901, "mail a.b@c.de, 10.0.0.1!")]
    d = table(spark, docs)
    field = pii.fit(d)
    r = pii.find(d.selectExpr("*", "1 AS n_ip", "2 AS spans"), field).collect()
    assert len(r) == len(docs) and [(x["n_email"], x["n_ip"]) for x in r if x["doc_id"] == 901] == [(1, 1), (1, 1)] and [x["n_email"] for x in r if x["doc_id"] is None] == [1]
    out = {x["doc_id"]: x["text"] for x in pii.redact(d.selectExpr("*", "1 AS t", "2 AS c0"), field).collect()}
    assert out[901] == "mail <EMAIL>, <IP>!" and out[902] is None and "<PHONE>" in out[0]
    assert pii.find(table(spark, ODD), pii.fit(table(spark, ODD))).count() == len(ODD)
    assert pii.find(table(spark, []), pii.fit(table(spark, []))).count() == 0


@pytest.mark.parametrize("name", ["quality_base", "lm_base", "pii_base"])
def test_bases_against_sql(spark, name):
    import duckdb

    from quire.llm import registry

    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = registry.queries()[name](spark, SF)
    names = sorted(df.columns)
    d = c.execute(registry.oracle_sql()[name])
    at = [[x[0] for x in d.description].index(n) for n in names]
    assert sorted(tuple(map(str, (r[n] for n in names))) for r in df.collect()) == sorted(tuple(str(r[i]) for i in at) for r in d.fetchall())


def test_toxicity_of_odd_rows_with_a_model(spark):
    docs, labels = _corpus(400)
    m = toxicity.fit(table(spark, docs + docs[:50]), table(spark, labels + labels[:9], "doc_id long, toxic int"))
    odd = table(spark, [*ODD, (7, "a zidiot b"), (7, "a zidiot b")]).selectExpr("*", "1 AS score", "2 AS __score", "3 AS __id")
    r = toxicity.score(odd, m).collect()
    assert len(r) == len(ODD) + 2 and all(0 <= x["score"] <= 1 for x in r) and [x["score"] >= 0.7 for x in r if x["doc_id"] == 7] == [True, True]
    kept = toxicity.without_toxic(odd, m)
    assert kept.columns == odd.columns and kept.count() == len(ODD)


def test_ties_between_cuts_are_settled_alike():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 3, 600) / 2
    y = a == 1
    rules = [quality.learn_list({"b": a, "a": a.copy()}, y, np.arange(600) % 3 == 0) for _ in range(2)]
    assert str(rules[0][0]) == str(rules[1][0]) == "a >= 1"


def test_toxicity_and_quality_on_the_tables(spark):
    q = toxicity.op2_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    assert q.where("toxic = 0 AND predicted = 1").count() <= 0.05 * q.count()
    k = quality.op3_quality_rules(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id")
    assert k.where("quality = 1 AND NOT base_failed AND NOT kept").count() <= 2
