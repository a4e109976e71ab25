"""Decontamination, exact repeats, near duplicates."""

import random
from functools import partial
from types import SimpleNamespace
from unittest.mock import MagicMock

import numpy as np
import pyarrow as pa
import pytest

from quire.llm import cluster, decontam, exact_dedup, graph, near_dedup

from .helpers import ODD, against_sql, table


def test_index_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 120)))) for i in range(80)] + [(1000, None), (1001, "W1, w2! É9é")]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 6)))) for i in range(40)] + [(77, None), (78, "é9É w"), (79, "w1 w2 w3 w4 w5 w6 w7 w8 w9"), (79, "w2 w1")]
    d, b = table(spark, docs), table(spark, items, "item_id long, text string")
    index = cluster.settle(decontam.build_index(d), "t")
    words = {i: decontam.item_words(t) for i, t in docs}
    phrases = {(i, tuple(w[k : k + 8])) for i, t in items for w in [decontam.item_words(t)] if w for k in range(max(1, len(w) - 7))}
    for r in decontam.search(index, items, slop=3).collect():
        w, hit, found, near = words[r["doc_id"]], set(), set(), set()
        for item, p in phrases:
            at = [k for k in range(len(w) - len(p) + 1) if tuple(w[k : k + len(p)]) == p]
            hit |= {x for k in at for x in range(k, k + len(p))}
            found |= {str(item)} if at else set()
            near |= {str(item)} if any(set(p) <= set(w[k : k + len(p) + 3]) for k in range(len(w))) else set()
        spans = r["spans"]
        assert (r["items"], r["near"]) == (sorted(found), sorted(near)) and found <= near
        assert {x for k in range(0, len(spans), 2) for x in range(spans[k], spans[k + 1])} == hit
    whole = decontam.decontaminate(d, b).drop("spans")
    blocks = [list(x) for x in decontam.item_blocks(b, block_bytes=200)]
    assert len(blocks) > 1 and sum(map(len, blocks)) == len(items)
    got, want = against_sql(spark, lambda documents, benchmark: decontam.decontaminate(documents, benchmark, slop=decontam.SLOP).drop("spans"), decontam.OP1_SQL, documents=d.where("doc_id < 1001"), benchmark=b)
    assert got == want and whole.count() == len(docs)


def test_several_blocks_give_what_one_gives(spark, monkeypatch):
    docs = table(spark, [(1, "a b c d"), (2, "c d e f"), (3, "x"), (None, "a b"), (4, None)])
    items = table(spark, [(i, t) for i, t in enumerate(["a b", "c d", "e f", "b c d"])], "item_id long, text string")
    run = lambda: sorted(map(tuple, decontam.decontaminate(docs, items, slop=1).collect()), key=str)
    one = run()
    old = decontam.item_blocks
    monkeypatch.setattr(decontam, "item_blocks", lambda b: old(b, block_bytes=70))
    assert run() == one
    assert [(r[0], r[2], r[3], r[5]) for r in one] == [(1, 4, 3, True), (2, 4, 2, True), (3, 0, 0, False), (4, 0, 0, False), (None, 2, 1, False)]


def test_planted_passages_go_and_all_columns_stay(spark):
    rng = random.Random(4)
    noise = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    items = [(i, noise(30)) for i in range(5)]
    part = lambda i, a, n: " ".join(items[i][1].split()[a : a + n])
    docs = [(1, noise(40) + " " + part(0, 3, 8) + " " + noise(40)), (2, noise(60)), (3, noise(9) + " " + part(1, 0, 20) + " " + part(2, 9, 9)), (4, part(3, 0, 7)), (None, part(4, 1, 9)), (5, None), (5, None), (6, "")]
    d, b = table(spark, docs).selectExpr("*", "'k' AS __key", "1 AS __KEY_", "2 AS segment"), table(spark, items, "item_id long, text string")
    r = {x["doc_id"]: x for x in decontam.decontaminate(d, b).collect()}
    assert [(r[i]["n_hit"], r[i]["n_items"], r[i]["contaminated"]) for i in (1, 2, 3, 4)] == [(8, 1, False), (0, 0, False), (29, 2, True), (0, 0, False)]
    left = decontam.without_contaminated(d, b)
    assert left.columns == d.columns and sorted(x["doc_id"] for x in left.collect()) == [2, 4, 5, 5, 6] and {x["__key"] for x in left.collect()} == {"k"}


def test_decontamination_of_odd_rows(spark):
    none = table(spark, [], "item_id long, text string")
    r = decontam.decontaminate(table(spark, ODD).selectExpr("*", "1 AS segment", "2 AS items"), none).collect()
    assert len(r) == len(ODD) and not any(x["contaminated"] for x in r)
    assert decontam.decontaminate(table(spark, []), table(spark, [(1, "a")], "item_id long, text string")).count() == 0


def test_two_stage_sort():
    rng = np.random.default_rng(1)
    for trial in range(150):
        n = int(rng.integers(0, 150))
        t = rng.integers(97, 97 + int(rng.integers(1, 5)), n).astype(np.uint8)
        if trial % 3 == 0 and n:
            t = np.tile(t[: max(1, n // 5)], 5)
        b = t.tobytes()
        small = exact_dedup.smaller_than_successor(t)
        assert small.tolist() == [b[i:] < b[i + 1 :] for i in range(len(b))]
        sa = exact_dedup.two_stage_sort(t, 56)
        assert sorted(sa.tolist()) == list(range(len(t)))
        assert [b[i : i + 50] for i in sa] == [x[:50] for x in sorted(b[i:] for i in range(len(b)))]
        for k, c in list(enumerate(exact_dedup.adjacent_common(t, sa, 50)))[1:]:
            x, y = b[sa[k] :][:50], b[sa[k - 1] :][:50]
            assert c == next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))


def _repeats(docs, n):
    out = []
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - n + 1):
            s = b[k : k + n]
            key = 1 << 62 if i is None else i
            first[s] = min(first.get(s, key), key)
    for i, t in docs:
        b = (t or "").encode()
        cut = [False] * len(b)
        for k in range(len(b) - n + 1):
            if first[b[k : k + n]] < (1 << 62 if i is None else i):
                cut[k : k + n] = [True] * n
        out.append((i, len(b), sum(cut), bytes(c for c, x in zip(b, cut) if not x)))
    return sorted(out, key=str)


@pytest.mark.parametrize("hot", [False, True])
def test_repeats_against_brute_force(spark, hot, monkeypatch):
    import hashlib

    if hot:
        monkeypatch.setattr(exact_dedup, "hot_anchors", lambda d, length, gram: np.sort(np.unique(np.concatenate([exact_dedup.anchors(p, length, gram)[1] for b in [d.select("doc_id", "text").toArrow()] for p in exact_dedup.tk.pieces(b)]))))
    rng = random.Random(5)
    parts = ["".join(rng.choice("abcdé \n") for _ in range(rng.randrange(5, 90))) for _ in range(12)]
    docs = [(i, "".join(rng.choice(parts) if rng.random() < 0.7 else rng.choice(["x", "yz", "a" * 70, "|" * 60]) for _ in range(rng.randrange(0, 9)))) for i in range(60)]
    docs += [(7, docs[7][1]), (7, docs[8][1]), (None, docs[3][1]), (None, docs[3][1]), (70, None), (71, ""), (72, "q" * 3000), (73, "q" * 200)]
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in exact_dedup.remove_repeats(table(spark, docs)).collect()), key=str)
    want = sorted(((i, n, m, hashlib.sha256(b).hexdigest()) for i, n, m, b in _repeats(docs, 50)), key=str)
    assert got == want


def _removed(spark, docs, length=50):
    import hashlib

    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["kept_sha256"]) for r in exact_dedup.remove_repeats(table(spark, docs), length=length).collect()), key=str)
    return got, sorted(((i, n, m, hashlib.sha256(b).hexdigest()) for i, n, m, b in _repeats(docs, length)), key=str)


def test_every_place_of_a_context_is_compared(spark):
    rng = random.Random(9)
    line, other = ("".join(rng.choice("abcdefghij ") for _ in range(60)) for _ in range(2))
    noise = lambda n: "".join(rng.choice("klmnopqrst ") for _ in range(n))
    docs = [(1, noise(70) + line + noise(70)), (2, line * 30), (3, "Q" * 60), (4, "Q" * 3000), (5, noise(9) + other + noise(9)), (6, "".join(other + "=" * 40 for _ in range(20)))]
    docs += [(6, "".join(other + "=" * 40 for _ in range(7)) + "."), (None, line * 5 + "!"), (None, line * 9 + "?" + "Q" * 500)]
    got, want = _removed(spark, docs)
    assert got == want and {n for i, _, n, _ in got if i == 2} == {1800} and {n for i, _, n, _ in got if i == 4} == {3000}


def test_short_texts_are_compared_by_all_their_anchors(spark):
    rng = random.Random(10)
    noise = lambda n: "".join(rng.choice("klmnopqrst ") for _ in range(n))
    docs = []
    for i in range(40):  # the context of every anchor of the second is the whole text; the first shares one end of it
        t = noise(58)
        docs += [(i, noise(40) + (t[:51] if i % 2 else t[7:]) + noise(40)), (100 + i, t)]
    got, want = _removed(spark, docs)
    assert got == want and sum(n for _, _, n, _ in got) >= 40 * 51


@pytest.mark.parametrize("length", [100, 137, 138, 200])
def test_repeats_of_other_lengths(spark, length):
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    shared = [noise(n) for n in (length - 1, length, length + 60, 2 * length + 20)]
    got, want = _removed(spark, [(i, noise(300) + shared[i % 4] + noise(300)) for i in range(16)], length=length)
    assert got == want and sum(n for _, _, n, _ in got) >= 9 * length


def test_hot_anchors_are_those_of_many_documents(spark):
    rng = random.Random(12)
    noise = lambda n: "".join(rng.choice("abcdefghij ") for _ in range(n))
    often, seldom = noise(60), noise(60)
    d = cluster.keyed_docs(table(spark, [(i, noise(60) + (often if i % 2 else seldom if i < 20 else "") + noise(60)) for i in range(120)]), "doc_id", "text")
    tk, i = exact_dedup.tk, np.arange(41)
    places = lambda t: set(tk.span_hash(tk.prefix_hash(np.frombuffer(t.encode(), np.uint8)), i, i + 20).tolist())
    hot = set(exact_dedup.hot_anchors(d, 50, 20).tolist())
    assert hot and hot <= places(often) and not hot & places(seldom)
    assert len(exact_dedup.hot_anchors(d, 50, 20, sample=30, part=4)) <= len(hot)  # 15 of 30 are not many


def test_repeats_in_nothing(spark):
    assert exact_dedup.remove_repeats(table(spark, [])).count() == 0
    r = exact_dedup.remove_repeats(table(spark, ODD).selectExpr("*", "1 AS key", "2 AS part"), texts_too=True).collect()
    assert len(r) == len(ODD) and all(x["n_removed"] == 0 for x in r)


def test_signature_tree():
    rng = np.random.default_rng(2)
    base = [np.unique(rng.integers(0, 400, 60)).astype(np.uint64) for _ in range(4)]
    sets = [np.unique(np.concatenate([b[rng.random(len(b)) < 0.95], rng.integers(0, 400, 3).astype(np.uint64)])) for b in base for _ in range(30)]
    sets.sort(key=len)
    size = np.array([len(s) for s in sets])
    want = {(i, j) for i in range(len(sets)) for j in range(len(sets)) if i < j and 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))}
    m = rng.integers(1, 4, len(sets))
    n, top = near_dedup.count_links(near_dedup.bitmaps(sets), size, m)
    assert want and n.tolist() == [sum(m[j] for j in range(len(sets)) if (min(i, j), max(i, j)) in want) for i in range(len(sets))]
    assert all(top[i] == top[j] for i, j in want)
    h = [k for k in range(len(sets)) if k % 2], [k for k in range(len(sets)) if not k % 2]
    order = [*h[0], *h[1]]
    n2, _ = near_dedup.count_links(near_dedup.bitmaps([sets[k] for k in order]), size[order], m[order], len(h[0]))
    cross = [sum(m[j] for j in order if (min(i, j), max(i, j)) in want and i % 2 != j % 2) for i in order]
    assert n2.tolist() == cross


def test_near_duplicates_against_sql(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rng = random.Random(9)
    words = [f"w{i}" for i in range(200)]
    docs = []
    for g in range(6):
        t = [rng.choice(words) for _ in range(60)]
        for _ in range(12):
            u = list(t)
            for _ in range(rng.randrange(0, 4)):
                u[rng.randrange(60)] = rng.choice(words)
            docs.append((len(docs) * 3, " ".join(u)))
    docs += [(900, docs[0][1]), (901, docs[0][1].upper().replace(" ", "\n")), (902, "one two"), (903, "One  two"), (904, ""), (905, None), (906, "x")]
    d = table(spark, docs)
    got, want = against_sql(spark, lambda documents: near_dedup.near_duplicates(documents).drop("key", "first_key"), near_dedup.OP7_SQL, documents=d)
    assert got == want
    kept = near_dedup.one_of_each(d.selectExpr("*", "1 AS key", "'z' AS __key", "3 AS __ONE", "4 AS __n")).collect()
    assert {(r["key"], r["__key"], r["__ONE"], r["__n"]) for r in kept} == {(1, "z", 3, 4)}
    assert sorted(r["doc_id"] for r in kept) == sorted({r[0] for r in got})  # component_id comes first by name


def test_near_duplicates_of_odd_rows(spark):
    r = near_dedup.near_duplicates(table(spark, ODD)).collect()
    assert sorted((x["doc_id"], x["n_shingles"], x["n_similar"]) for x in r if x["doc_id"] is not None) == [(1, 1, 1), (1, 1, 1), (2, 0, 0), (3, 0, 0), (4, 1, 0)]
    assert near_dedup.one_of_each(table(spark, ODD)).count() == 6
    assert near_dedup.near_duplicates(table(spark, [])).count() == 0


def test_common_shingles_do_not_join_clusters(spark, monkeypatch):
    """Pairs of near duplicates that all hold one passage: what is compared stays as small as the pairs."""
    largest = []

    def spy(nodes, edges):
        out = graph.components(nodes, edges)
        largest.append(out.groupBy("label").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(near_dedup, "components", spy)
    passage = " ".join(f"common{i}" for i in range(30))
    rows = [(2 * i + j, " ".join(f"w{i}x{n}" for n in range(100)) + f" {passage}" + " end" * j) for i in range(40) for j in range(2)]
    got = near_dedup.near_duplicates(table(spark, rows)).collect()
    assert all(r["n_similar"] == 1 and r["component_id"] == r["doc_id"] // 2 * 2 for r in got) and len(got) == 80
    assert largest == [2, 2]


def test_shingles_take_the_same_room_in_any_number_of_buckets(monkeypatch):
    rng = random.Random(4)
    docs = [(i, " ".join(f"w{rng.randrange(5000)}" for _ in range(100)), i) for i in range(600)]
    batch = pa.RecordBatch.from_pylist([dict(zip(("doc_id", "text", "key"), r)) for r in docs])
    monkeypatch.setattr(near_dedup, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)), raising=False)

    class Sent(Exception):
        pass

    class Rows:
        def select(self, *names):
            return self

        def mapInArrow(self, send, schema):
            raise Sent(sum(b.nbytes for b in send(iter([batch]))))

    def sent(buckets):
        with pytest.raises(Sent) as e:
            near_dedup.shared_counts(Rows(), 5, buckets, 4)
        return e.value.args[0]

    assert sent(64) < 1.5 * sent(4)


def test_a_part_sends_a_row_to_a_bucket(spark, monkeypatch):
    """However many pieces the texts of a part make, with the contexts of all of them."""
    grouped = MagicMock()
    monkeypatch.setattr(exact_dedup, "by", lambda *a: grouped)
    monkeypatch.setattr(exact_dedup.tk, "pieces", partial(exact_dedup.tk.pieces, size=200))
    exact_dedup._fetch(MagicMock(), MagicMock(), 4, 3, "u1")
    run = grouped.cogroup.return_value.applyInArrow.call_args[0][0]
    texts = [f"{i:03d}" * 30 for i in range(30)]
    key, a, b = np.arange(30), np.full(30, 6, "u4"), np.full(30, 66, "u4")
    wanted = dict(keys=key.astype("i8"), ids=key.astype("i8"), a=a, b=b, gram=key.astype("u4"), more=np.zeros(30, "u4"), also=np.zeros(0, "i8"), at=np.zeros(0, "u4"))
    got = run(pa.table({"doc_id": key, "key": key, "text": texts}), pa.table({n: pa.array([v.tobytes()], pa.binary()) for n, v in wanted.items()})).to_pylist()
    assert sorted(r["bucket"] for r in got) == [0, 1, 2]
    for r in got:
        assert r["bytes"].decode() == "".join(texts[k][6:66] for k in np.frombuffer(r["keys"], "i8"))
    assert sorted(k for r in got for k in np.frombuffer(r["keys"], "i8")) == list(range(30))
