"""Exact Jaccard joins of shingle sets with signature trees.

1. Documents of equal sets form a class; one of each goes on.
2. Shingles are counted by hash over the corpus. A set can only be linked if `threshold` of its shingles are in other documents too;
   the few that remain are the candidates. (Hash collisions, and copies that are read in different batches, only let more remain.)
3. In any order of all shingles, two linked sets share one of the first of each; candidates that share one of those are joined to
   clusters. Shingles are ordered by how many candidates have them, rarest first, so that what many texts have joins only texts that
   consist of it, and clusters do not grow together as the corpus grows.
4. Clusters are split into blocks by set size, and pairs of blocks whose sizes allow a link are compared by dual traversal of
   signature trees: a node holds the OR of the token bitmaps below it and their range of sizes, and a pair of nodes is left out
   when the bits they have in common, or their sizes, cannot make up the overlap that a link needs.
5. Links are counted with the sizes of the classes, and components follow from a spanning forest of each pair of blocks.

No pair of documents is ever written out, and a cluster of any size is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textkit as tk
from .cluster import buckets_for, by, keyed_docs, new_names, part_of, places, settle
from .graph import components

SHINGLE = 5
NUM, DEN = 80, 100  # linked when DEN * intersection >= NUM * union
BLOCK, BLOCK_TOKENS = 1_000, 1 << 18  # sets of a block, at most, and tokens (times two at most), unless a single set has more
SIGNATURE = 512
FEW = 4  # classes of a batch that have a shingle; where there are more, it travels once
LEAF = 32
FAN = 4
U64 = tk.U64


def shingles(p: tk.Piece, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text) of the distinct shingles of a piece, by text and hash. A text of 1 to k-1 words has one, the whole sequence."""
    buf = tk.LOWER[p.buf]
    a, b = tk.spans(tk.NOT_SPACE[buf])
    first = np.searchsorted(a, np.append(p.start, len(buf) + 1))
    h = tk.span_hash(tk.prefix_hash(buf), a, b)
    n = np.diff(first)
    doc = np.repeat(np.arange(len(n)), n)
    w = tk.window_hash(h, k)
    i = np.flatnonzero(doc[: len(w)] == doc[k - 1 :]) if len(w) else np.zeros(0, np.int64)
    hs, ds = [w[i]], [doc[i]]
    for m in range(1, k):
        d = np.flatnonzero(n == m)
        if len(d):
            x = np.full(len(d), m, U64)
            for j in range(m):
                x = tk.mix(x) * U64(0x9FB21C651E98DF25) + h[first[d] + j]
            hs.append(tk.mix(x))
            ds.append(d)
    hs, ds = np.concatenate(hs), np.concatenate(ds)
    o = np.argsort(hs)
    o = o[np.argsort(ds[o], kind="stable")]
    hs, ds = hs[o], ds[o]
    keep = np.concatenate(([True], (hs[1:] != hs[:-1]) | (ds[1:] != ds[:-1]))) if len(hs) else np.zeros(0, bool)
    return hs[keep], ds[keep]


def _signatures(h: np.ndarray, d: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each set and two 64-bit sums that tell sets apart."""
    cut = np.searchsorted(d, np.arange(docs + 1))
    sums = []
    for salt in (1, 2):
        c = np.concatenate((np.zeros(1, U64), np.cumsum(tk.mix(h + U64(salt) * U64(0x632BE59BD9B4E019)))))
        sums.append(c[cut[1:]] - c[cut[:-1]])
    return np.diff(cut), sums[0], sums[1]


def shingle_sets(d: DataFrame, k: int) -> DataFrame:
    """doc_id, key, n, s1, s2 of every row of keyed documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in tk.pieces(batch):
                n, s1, s2 = _signatures(*shingles(p, k), len(p.start))
                yield pa.RecordBatch.from_arrays([p.ids, batch.column("key").slice(p.row, len(p.start)), pa.array(n), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64))], ["doc_id", "key", "n", "s1", "s2"])

    return d.mapInArrow(run, "doc_id long, key long, n long, s1 long, s2 long")


COUNTED = "bucket int, batch long, keys binary, doc binary, n binary, h binary"


def shared_counts(d: DataFrame, k: int, buckets: int, parts: int) -> DataFrame:
    """key, shared: how many shingles of each row are in other documents too (never too few).

    Shingles travel as 4 bytes each and the step from one document of the batch to the next, packed by bucket; the keys of a batch
    travel once. So what a shingle takes does not depend on the number of buckets.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId()  # below 2**24
        for batch in (s for b in batches for s in tk.slices(b)):
            got = []
            sig = []
            for p in tk.pieces(batch):
                h, x = shingles(p, k)
                sig.append(_signatures(h, x, len(p.start))[1])
                got.append((h, x + p.row))
            if not got:
                continue
            h, x = (np.concatenate(v) for v in zip(*got))
            s = np.concatenate(sig)
            # of rows of one class in this batch only the first is sent
            _, one = np.unique(s, return_index=True)
            first = np.zeros(len(s), bool)
            first[one] = True
            h, x = h[first[x]], x[first[x]]
            # what many classes of this batch have is shared: it is counted here, and goes on once to tell others
            order, heads = tk.group_ids(h)
            size = np.diff(np.append(heads, len(order)))
            many = np.repeat(size > FEW, size)
            rows = [(number % buckets, number, np.asarray(batch.column("key")).astype("i8").tobytes(), None, tk.squeeze(np.bincount(x[order[many]], minlength=len(s))), None)]
            rest = np.ones(len(h), bool)
            rest[order[many]] = False
            # in order of the documents, as the steps between them are then small
            for at, known in ((np.flatnonzero(rest), False), (order[heads[size > FEW]], True)):
                q = ((h[at] >> U64(32)) % U64(buckets)).astype(np.int64)
                o = np.argsort(q.astype(np.uint16) if buckets < 1 << 16 else q, kind="stable")
                for b, m, n in tk.runs(q[o]):
                    i = at[o[m:n]]
                    rows.append((b, number, None, None if known else tk.squeeze(np.diff(x[i], prepend=0)), None, (h[i] & U64(0xFFFFFFFF)).astype("u4").tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int32(), pa.int64()] + [pa.binary()] * 4)], [c.split(" ")[0] for c in COUNTED.split(", ")])
            number += 1 << 24

    def count(t: pa.Table) -> pa.Table:
        w = t.to_pylist()
        out = [(r["batch"], r["keys"], None, r["n"]) for r in w if r["keys"] is not None]
        w = [r for r in w if r["h"] is not None]
        if w:
            hs = [np.frombuffer(r["h"], "u4") for r in w]
            order, heads = tk.group_ids(np.concatenate(hs))
            size = np.diff(np.append(heads, len(order)))
            shared = np.empty(len(order), bool)
            shared[order] = np.repeat(size > 1, size)
            at = 0
            for r, h in zip(w, hs):
                if r["doc"] is not None:
                    u, n = np.unique(np.cumsum(tk.unsqueeze(r["doc"]))[shared[at : at + len(h)]], return_counts=True)
                    if len(u):
                        out.append((r["batch"], None, tk.squeeze(np.diff(u, prepend=0)), tk.squeeze(n)))
                at += len(h)
        return pa.table({n: pa.array(c, x) for n, c, x in zip(("batch", "keys", "doc", "n"), zip(*out) if out else [()] * 4, [pa.int64()] + [pa.binary()] * 3)})

    def add(t: pa.Table) -> pa.Table:
        w = t.to_pylist()
        own = next(r for r in w if r["keys"] is not None)
        total = tk.unsqueeze(own["n"])
        for r in w:
            if r["doc"] is not None:
                total[np.cumsum(tk.unsqueeze(r["doc"]))] += tk.unsqueeze(r["n"])
        some = total > 0
        return pa.table({"key": pa.array(np.frombuffer(own["keys"], "i8")[some]), "shared": pa.array(total[some])})

    sent = d.select("doc_id", "text", "key").mapInArrow(send, COUNTED)
    return by(by(sent, buckets, "bucket").applyInArrow(count, "batch long, keys binary, doc binary, n binary"), parts, "batch").applyInArrow(add, "key long, shared long")


def _rank_bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> U64(32)) % U64(buckets)).astype(np.int64)


def _sets_of(d: DataFrame, wanted: DataFrame, k: int, parts: int, buckets: int) -> DataFrame:
    """key, n, hashes (sorted, 8 bytes each) of the rows whose keys are wanted; and, with a null key, how many sets of a part have each shingle of a bucket (part, bucket, h, count), in order of the whole hashes."""

    def run(texts: pa.Table, want: pa.Table) -> pa.Table:
        w = set(want.column("key").to_pylist())
        keys = texts.column("key").to_pylist()
        out: dict[int, bytes] = {}
        ask: list[tuple] = []
        keep = [i for i, x in enumerate(keys) if x in w]
        if keep:
            for p in tk.pieces(texts.take(pa.array(keep)).select(["doc_id", "text"])):
                h, x = shingles(p, k)
                cut = np.searchsorted(x, np.arange(len(p.start) + 1))
                for i in range(len(p.start)):
                    out[keys[keep[p.row + i]]] = h[cut[i] : cut[i + 1]].tobytes()
            u, n = np.unique(np.frombuffer(b"".join(out.values()), "u8"), return_counts=True)
            q = _rank_bucket(u, buckets)
            o = np.argsort(q, kind="stable")
            part = texts.column("part")[0].as_py()
            ask = [(part, b, (u[o[i:j]] & U64(0xFFFFFFFF)).astype("u4").tobytes(), tk.squeeze(n[o[i:j]])) for b, i, j in tk.runs(q[o])]
        none = [None] * len(ask)
        part, bucket, h, count = ([None] * len(out) + list(c) for c in (zip(*ask) if ask else [()] * 4))
        return pa.table({
            "key": pa.array([*out, *none], pa.int64()), "n": pa.array([*(len(x) // 8 for x in out.values()), *none], pa.int64()), "hashes": pa.array([*out.values(), *none], pa.binary()),
            "part": pa.array(part, pa.int32()), "bucket": pa.array(bucket, pa.int32()), "h": pa.array(h, pa.binary()), "count": pa.array(count, pa.binary()),
        })

    schema = "key long, n long, hashes binary, part int, bucket int, h binary, count binary"
    return by(d.withColumn("part", part_of(parts)), parts, "part").cogroup(by(wanted.withColumn("part", part_of(parts)), parts, "part")).applyInArrow(run, schema)


def _ranks(asked: DataFrame, buckets: int) -> DataFrame:
    """part, bucket, rank: for each shingle that a part asked for the bits of the number of sets that have it, a byte each. Shingles of a bucket that agree in 32 bits count as one, in all parts alike."""

    def run(t: pa.Table) -> pa.Table:
        hs = [np.frombuffer(x, "u4") for x in t.column("h").to_pylist()]
        _, inv = np.unique(np.concatenate(hs), return_inverse=True)
        n = np.bincount(inv, np.concatenate([tk.unsqueeze(x) for x in t.column("count").to_pylist()]))
        rank = np.frexp(n)[1].astype("u1")[inv]
        upto = np.cumsum([len(h) for h in hs])
        return pa.table({"part": t.column("part"), "bucket": t.column("bucket"), "rank": pa.array([x.tobytes() for x in np.split(rank, upto[:-1])], pa.binary())})

    return by(asked, buckets, "bucket").applyInArrow(run, "part int, bucket int, rank binary")


def prefix(h: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first hashes of a set, by rank and hash: a set that is linked with it has one of them among its own first."""
    m = len(h) - -(-len(h) * NUM // DEN) + 1
    return h[np.lexsort((h, rank))[:m]]


def _prefix_edges(sets: DataFrame, ranks: DataFrame, parts: int, buckets: int) -> DataFrame:
    """Edges a, b between candidates that share one of the first hashes of each. Per part and hash only the smallest key travels. buckets: those of the ranks, too."""

    def send(t: pa.Table, told: pa.Table) -> pa.Table:
        rows: list[tuple] = []
        if t.num_rows:
            sets = [np.frombuffer(x, "u8") for x in t.column("hashes").to_pylist()]
            u = np.unique(np.concatenate(sets))
            rank = np.empty(len(u), np.uint8)
            order = np.argsort(told.column("bucket").combine_chunks().to_numpy(), kind="stable")
            told_of = told.column("rank")
            rank[np.argsort(_rank_bucket(u, buckets), kind="stable")] = np.frombuffer(b"".join(told_of[int(i)].as_py() for i in order), np.uint8)
            first = [prefix(h, rank[np.searchsorted(u, h)]) for h in sets]
            h, k = np.concatenate(first), np.repeat(t.column("key").combine_chunks().to_numpy(), [len(x) for x in first])
            o = np.lexsort((k, h))
            h, k = h[o], k[o]
            heads = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
            low = np.repeat(k[heads], np.diff(np.append(heads, len(h))))
            e = np.unique(np.stack([low, k], axis=1)[low != k], axis=0)
            rows = [(-1, e[:, 0].tobytes(), e[:, 1].tobytes())]
            h, k = h[heads], k[heads]
            q = _rank_bucket(h, buckets)
            o = np.argsort(q, kind="stable")
            rows += [(b, h[o[i:j]].tobytes(), k[o[i:j]].tobytes()) for b, i, j in tk.runs(q[o])]
        return pa.table({n: pa.array(c, x) for n, c, x in zip(("bucket", "a", "b"), zip(*rows) if rows else [()] * 3, [pa.int32(), pa.binary(), pa.binary()])})

    def join(t: pa.Table) -> pa.Table:
        a, b = (np.concatenate([np.frombuffer(x, "i8") for x in t.column(c).to_pylist()]) for c in ("a", "b"))
        if t.column("bucket")[0].as_py() >= 0:
            o = np.lexsort((b, a))
            a, b = a[o], b[o]
            heads = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1])))
            a = np.repeat(b[heads], np.diff(np.append(heads, len(a))))
        e = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
        return pa.table({"a": pa.array(e[:, 0]), "b": pa.array(e[:, 1])})

    # edges found within tasks are spread again, so that they are not all in one group
    mine = sets.select("key", "hashes").withColumn("part", part_of(parts))
    sent = by(mine, parts, "part").cogroup(by(ranks, parts, "part")).applyInArrow(send, "bucket int, a binary, b binary")
    spread = F.when(F.col("bucket") < 0, -1 - F.pmod(F.xxhash64("a"), F.lit(buckets))).otherwise(F.col("bucket")).cast("int")
    return by(sent.withColumn("bucket", spread), buckets, "bucket").applyInArrow(join, "a long, b long").distinct()


# -- signature trees


@dataclass
class Node:
    """OR of the bitmaps of the sets below, their range of sizes, and either children or the rows of a leaf."""

    bits: np.ndarray
    low: int
    high: int
    rows: slice
    below: list[Node] = field(default_factory=list)


def build_tree(bits: np.ndarray, size: np.ndarray, leaf: int = LEAF, fan: int = FAN) -> Node | None:
    """A tree over rows that are sorted by size."""
    level = [Node(np.bitwise_or.reduce(bits[i : i + leaf], axis=0), int(size[i : i + leaf].min()), int(size[i : i + leaf].max()), slice(i, min(i + leaf, len(size)))) for i in range(0, len(size), leaf)]
    while len(level) > 1:
        level = [Node(np.bitwise_or.reduce([n.bits for n in g]), min(n.low for n in g), max(n.high for n in g), slice(g[0].rows.start, g[-1].rows.stop), g) for g in (level[i : i + fan] for i in range(0, len(level), fan))]
    return level[0] if level else None


def may_link(a: Node, b: Node, num: int = NUM, den: int = DEN) -> bool:
    """Whether any set below a can be linked with any below b: by size, and by the greatest overlap their bitmaps allow."""
    if a.high * den < b.low * num or b.high * den < a.low * num:
        return False
    most = min(int(np.bitwise_count(a.bits & b.bits).sum()), a.high, b.high)
    return most * (num + den) >= num * (a.low + b.low)


def traverse(a: Node, b: Node, num: int = NUM, den: int = DEN) -> Iterator[tuple[slice, slice]]:
    """Pairs of leaves that may hold a link. Given one tree twice, each unordered pair once."""
    stack = [(a, b)]
    while stack:
        x, y = stack.pop()
        if not may_link(x, y, num, den):
            continue
        if not x.below and not y.below:
            yield x.rows, y.rows
        elif x is y:
            stack += [(x.below[i], x.below[j]) for i in range(len(x.below)) for j in range(i, len(x.below))]
        elif x.below and (not y.below or x.rows.stop - x.rows.start >= y.rows.stop - y.rows.start):
            stack += [(c, y) for c in x.below]
        else:
            stack += [(x, c) for c in y.below]


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """Exact bitmaps over the tokens that at least two of the sets hold; other tokens make no overlap."""
    own = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    token, inv, n = np.unique(np.concatenate(sets) if sets else np.zeros(0, U64), return_inverse=True, return_counts=True)
    del token
    number = np.cumsum(n > 1) - 1
    keep = n[inv] > 1
    words = max(1, -(-int((n > 1).sum()) // 64))
    out = np.zeros((len(sets), words), U64)
    bit, own = number[inv[keep]], own[keep]
    del inv, keep
    for at in range(0, len(bit), 1 << 18):  # in runs, as the indexed update makes copies
        b = bit[at : at + (1 << 18)]
        np.bitwise_or.at(out, (own[at : at + (1 << 18)], b >> 6), U64(1) << (b & 63).astype(U64))
    return out


def linked_blocks(bits: np.ndarray, size: np.ndarray, split: int | None = None, num: int = NUM, den: int = DEN) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """Pairs of leaves with a matrix that tells which of their rows are linked, in one collection (each unordered pair of leaves once, with itself too) or, with split, between rows before and from it. Rows of each side are sorted by size."""
    if split is None:
        a = b = build_tree(bits, size)
        shift = 0
    else:
        a, b, shift = build_tree(bits[:split], size[:split]), build_tree(bits[split:], size[split:]), split
    if a is None or b is None:
        return
    for r, s in traverse(a, b, num, den):
        s = slice(s.start + shift, s.stop + shift)
        overlap = np.zeros((r.stop - r.start, s.stop - s.start), np.int64)
        for w in range(0, bits.shape[1], 128):
            overlap += np.bitwise_count(bits[r, None, w : w + 128] & bits[None, s, w : w + 128]).sum(axis=2, dtype=np.int64)
        mask = (overlap * (num + den) >= num * (size[r, None] + size[None, s])) & (overlap > 0)
        if r == s:
            np.fill_diagonal(mask, False)
        if mask.any():
            yield r, s, mask


def count_links(bits: np.ndarray, size: np.ndarray, members: np.ndarray, split: int | None = None, num: int = NUM, den: int = DEN) -> tuple[np.ndarray, np.ndarray]:
    """For each row how many members the rows linked with it have, and the smallest row of its component. No list of pairs is made."""
    count, parent = np.zeros(len(size), np.int64), list(range(len(size)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for r, s, mask in linked_blocks(bits, size, split, num, den):
        count[r] += mask @ members[s]
        if r != s:
            count[s] += members[r] @ mask
        x, y = np.array([root(i) for i in range(r.start, r.stop)]), np.array([root(i) for i in range(s.start, s.stop)])
        i, j = np.nonzero(mask & (x[:, None] != y[None, :]))
        for p, q in {*zip(x[i].tolist(), y[j].tolist())}:
            p, q = root(p), root(q)
            if p != q:
                parent[max(p, q)] = min(p, q)
    return count, np.array([root(i) for i in range(len(size))], np.int64)


PACKED = "cluster long, block long, low long, high long, sig array<int>, keys binary, members binary, pivot binary, gone binary, n_gone binary, extra binary, n_extra binary"
_PACKED = [x.split(" ") for x in PACKED.split(", ")]


def _pack(t: pa.Table) -> pa.Table:
    """Blocks as one row each. Sets are written as their difference from the block's first, of which near duplicates have little.

    sig, for blocks of clusters that have many: for each of `SIGNATURE` classes of tokens the most that any set of the block holds.
    """
    c, b, n, k, m, many = (np.asarray(t.column(x).combine_chunks()) for x in ("cluster", "block", "n", "key", "members", "many"))
    hashes = t.column("hashes")
    order = np.lexsort((k, n, b, c))
    heads = np.flatnonzero(np.concatenate(([True], (c[order][1:] != c[order][:-1]) | (b[order][1:] != b[order][:-1]))))
    out = []
    for i, j in zip(heads, np.append(heads[1:], len(order))):
        at = order[i:j]
        pivot = np.frombuffer(hashes[int(at[0])].as_py(), "u8")
        gone, extra = [], []
        sig = np.zeros(SIGNATURE, np.int64)
        for x in at.tolist():
            s = np.frombuffer(hashes[x].as_py(), "u8")
            p = np.minimum(np.searchsorted(pivot, s), len(pivot) - 1)
            inside = pivot[p] == s
            missing = np.ones(len(pivot), bool)
            missing[p[inside]] = False
            gone.append(np.flatnonzero(missing).astype("u4"))
            extra.append(s[~inside])
            if many[x]:
                sig = np.maximum(sig, np.bincount((s % U64(SIGNATURE)).astype(np.int64), minlength=SIGNATURE))
        size = lambda v: np.array([len(x) for x in v], "u4").tobytes()
        out.append((int(c[at[0]]), int(b[at[0]]), int(n[at[0]]), int(n[at[-1]]), sig.tolist() if many[at[0]] else None, k[at].astype("i8").tobytes(), m[at].astype("i8").tobytes(), pivot.tobytes(), np.concatenate(gone).tobytes(), size(gone), np.concatenate(extra).tobytes(), size(extra)))
    return pa.table({f: pa.array(v, {"long": pa.int64(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}[kind]) for v, (f, kind) in zip(zip(*out), _PACKED)})


def _unpack(r: dict) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(keys, members, sets) of a packed block."""
    of = lambda k, d: np.frombuffer(r[k], d)
    pivot, gone, extra = of("pivot", "u8"), np.split(of("gone", "u4"), np.cumsum(of("n_gone", "u4"))[:-1]), np.split(of("extra", "u8"), np.cumsum(of("n_extra", "u4"))[:-1])
    return of("keys", "i8"), of("members", "i8"), [np.concatenate((np.delete(pivot, g), e)) for g, e in zip(gone, extra)]


def _compare(work: DataFrame, tasks: int) -> DataFrame:
    """Links of each pair of blocks: rows (key, other, links): with other null, how many documents key is linked with; else an edge."""

    def run(t: pa.Table) -> pa.Table:
        out: list[tuple] = []
        names = [t.column(c).to_pylist() for c in ("cluster", "i", "j", "side")]
        order = sorted(range(t.num_rows), key=lambda r: tuple(n[r] for n in names))
        while order:
            first = order.pop(0)
            one = _unpack(t.slice(first, 1).to_pylist()[0])
            split = None
            if names[1][first] != names[2][first]:
                two = _unpack(t.slice(order.pop(0), 1).to_pylist()[0])
                split = len(one[0])
                one = np.concatenate((one[0], two[0])), np.concatenate((one[1], two[1])), one[2] + two[2]
            key, m, sets = one
            size, bits = np.array([len(s) for s in sets]), bitmaps(sets)
            del sets, one
            n, top = count_links(bits, size, m, split)
            out += [(int(key[i]), None, int(n[i])) for i in np.flatnonzero(n)]
            out += [(int(key[i]), int(key[top[i]]), 0) for i in np.flatnonzero(top != np.arange(len(top)))]
        cols = list(zip(*out)) if out else [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("key", "other", "links"), cols)})

    return by(work, tasks, "task").applyInArrow(run, "key long, other long, links long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE) -> DataFrame:
    """A row for each row of docs: doc_id, n_shingles, n_similar (other rows linked directly), component_id (smallest id reachable), key (of the row) and first_key (of the row with that id).

    Two rows are linked when the Jaccard similarity of their sets of k-word shingles is at least 0.8. Null and empty texts have empty
    sets and are linked with nothing; null ids are only reported where a component has no other; repeated rows are rows of their own
    and linked with each other; an empty table gives an empty one; other columns are ignored.
    """
    d = keyed_docs(docs, id_col, text_col)
    parts, buckets = buckets_for(docs, 6 << 20), buckets_for(docs, 8 << 20)
    sets = settle(shingle_sets(d, k), "shingle-sets", free=False)
    whole = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    classes = settle(sets.where("n > 0").groupBy("n", "s1", "s2").agg(F.count(F.lit(1)).alias("members"), F.min(whole).alias("first")).select("n", "s1", "s2", "members", F.col("first.key").alias("key"), "first"), "classes", free=False)
    shared = settle(shared_counts(d, k, buckets, parts), "shared")
    # a class is judged by any of its rows that was counted
    judged = sets.where("n > 0").join(shared, "key").where(F.col("shared") * DEN >= F.col("n") * NUM).select("n", "s1", "s2").distinct()
    wanted = settle(classes.join(judged, ["n", "s1", "s2"], "left_semi").select("key", "members"), "candidates", free=False)
    few = max(4, buckets // 4)
    fetched = settle(_sets_of(d, wanted.select("key"), k, parts, few), "candidate-sets")
    found, asked = fetched.where("key IS NOT NULL").select("key", "n", "hashes"), fetched.where("key IS NULL").select("part", "bucket", "h", "count")
    edges = settle(_prefix_edges(found, settle(_ranks(asked, few), "ranks", free=False), parts, few), "prefix-edges")
    clusters = components(found.select(F.col("key").alias("v")), edges).withColumnRenamed("v", "key").withColumnRenamed("label", "cluster")
    # blocks by size within clusters, without sorting a cluster in one task; of larger sets fewer make a block
    placed = found.select("key", "n").join(clusters, "key").join(wanted, "key")
    placed = placed.join(placed.groupBy("cluster").count().where("count > 1"), "cluster").drop("count").withColumn("size_class", F.floor(F.log2("n")))
    placed = places(placed.orderBy("cluster", "n", "key"))
    heads = placed.groupBy("cluster", "size_class").agg(F.min("place").alias("head"))
    per = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.expr(f"shiftright({BLOCK_TOKENS}, CAST(size_class AS INT))")))
    block = F.col("size_class") * F.lit(1 << 40) + F.floor((F.col("place") - F.col("head")) / per)
    placed = settle(placed.join(heads, ["cluster", "size_class"]).select("key", "cluster", "n", "members", block.cast("long").alias("block")), "blocks", free=False)
    many = placed.groupBy("cluster").agg((F.min("block") < F.max("block")).alias("many"))
    # small clusters share tasks; a block, and a pair of blocks, is never split
    tasks = max(8, 4 * buckets)
    loaded = placed.join(many, "cluster").join(found.select("key", "hashes"), "key").withColumn("task", F.pmod(F.xxhash64("cluster", "block"), F.lit(tasks)))
    packed = settle(by(loaded, buckets, "task").applyInArrow(_pack, PACKED), "packed", free=False)
    # the roots of the blocks' trees: pairs that cannot make up the overlap of a link by size or signature are left out before any is loaded
    side = lambda x: packed.select("cluster", F.col("block").alias(x), F.col("low").alias(f"{x}_low"), F.col("high").alias(f"{x}_high"), F.col("sig").alias(f"{x}_sig"))
    most = F.least(F.aggregate(F.zip_with("i_sig", "j_sig", lambda x, y: F.least(x, y)), F.lit(0), lambda a, x: a + x), "i_high", "j_high")
    near = (F.col("i") == F.col("j")) | ((F.col("i_high") * DEN >= F.col("j_low") * NUM) & (most * (NUM + DEN) >= NUM * (F.col("i_low") + F.col("j_low"))))
    pairs = settle(side("i").join(side("j"), "cluster").where((F.col("i") <= F.col("j")) & near).select("cluster", "i", "j"), "block-pairs", free=False)
    sides = pairs.select("cluster", "i", "j", F.col("i").alias("block"), F.lit(0).alias("side")).unionByName(pairs.where("i <> j").select("cluster", "i", "j", F.col("j").alias("block"), F.lit(1).alias("side")))
    work = packed.drop("sig", "low", "high").join(sides, ["cluster", "block"]).withColumn("task", F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(tasks)))
    compared = settle(_compare(work, tasks), "links")
    counts = compared.where("other IS NULL").groupBy("key").agg(F.sum("links").alias("links"))
    joined = components(wanted.select(F.col("key").alias("v")), compared.where("other IS NOT NULL").select(F.col("key").alias("a"), F.col("other").alias("b")))
    tops = classes.join(joined.withColumnRenamed("v", "key"), "key").select("key", "label", "first")
    least = tops.groupBy("label").agg(F.min("first").alias("component"))
    info = tops.join(least, "label").select("key", "component").join(counts, "key", "left")
    known = classes.join(info, "key", "left").select("n", "s1", "s2", "members", F.coalesce("component", "first").alias("component"), F.coalesce("links", F.lit(0)).alias("links"))
    out = _by_class(sets, known)
    full = F.col("n") > 0
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(full, F.col("members") - 1 + F.col("links")).otherwise(0).cast("long").alias("n_similar"), F.when(full, F.col("component.doc_id")).otherwise(F.col("doc_id")).alias("component_id"), "key", F.when(full, F.col("component.key")).otherwise(F.col("key")).alias("first_key"),
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs, all columns as they are, that have the smallest id of their component (nulls last); of rows that repeat one another in id and text one stays, unless they have no words."""
    key, one, n = new_names(docs, "__key", "__one", "__n")
    groups = near_duplicates(docs, id_col, text_col)
    keep = settle(groups.where("key = first_key").select(F.col("key").alias(key), (F.col("n_shingles") > 0).alias(one)).distinct(), "kept", free=False)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    i = F.col(f"`{id_col}`").cast("long")
    joined = docs.withColumn(key, F.xxhash64(i.isNull(), i, text)).join(keep, key)
    first = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return joined.withColumn(n, first).where(~F.col(one) | (F.col(n) == 1)).select(*(F.col(f"`{c}`") for c in docs.columns))


SALTS = 16


def _by_class(sets: DataFrame, known: DataFrame) -> DataFrame:
    """What is known of each class, for its rows. Classes with a thousandth of all rows, at most 1000, are salted."""
    total = sets.count()
    hot = known.where(F.col("members") * 1000 > total).select("s1").distinct()
    names = [r[0] for r in hot.collect()] if total > 100_000 else []
    is_hot = F.col("s1").isin(names) if names else F.lit(False)
    left = sets.withColumn("salt", F.when(is_hot, F.pmod("key", F.lit(SALTS)).cast("int")).otherwise(0))
    right = known.withColumn("salt", F.explode(F.when(is_hot, F.array(*(F.lit(i) for i in range(SALTS)))).otherwise(F.array(F.lit(0)))))
    return left.join(right, ["n", "s1", "s2", "salt"], "left")


def op7_signature_tree_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, by 5-word shingles."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("key", "first_key")


OP7_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[k : k + 4], ' ') AS x FROM w, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(ws) - 4))) AS k) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 80 * (x.n + y.n - i)),
r AS (SELECT a AS doc_id, a AS top FROM l UNION SELECT r.doc_id, l.b FROM r JOIN l ON r.top = l.a),
c AS (SELECT doc_id, min(top) AS top FROM r GROUP BY doc_id),
k AS (SELECT a AS doc_id, count(*) AS n_similar FROM l GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, CAST(coalesce(n_similar, 0) AS BIGINT) AS n_similar, least(w.doc_id, coalesce(top, w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id) LEFT JOIN c USING (doc_id)
"""
