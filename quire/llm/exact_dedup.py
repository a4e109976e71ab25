"""Removal of repeated byte strings with suffix arrays built by two-stage sorting.

Every stretch of `length` bytes that also starts in a document with a smaller id is removed. No task ever sees the corpus. Texts are
shuffled twice, by document, to fetch what has to be compared and to cut out what was found; all else that travels is hashes and places:

1. Anchors. Each text is winnowed: of every `length` bytes at least one k-gram is chosen by content alone, so equal stretches choose
   equal anchors. Per anchor only two hashes travel: of the k-gram, and of its context, which is all bytes that a stretch holding
   the anchor can reach. They are first reduced within the task to one document per context.
2. Contexts that occur as a whole in a smaller document are removed as a whole. Of anchors that are shared but whose contexts differ,
   one representative of each context is kept, and the other places of that context (they have the same id) travel along with it.
3. The bytes of those contexts are fetched and brought together by anchor. A suffix array is built of them by two-stage sorting:
   only suffixes smaller than their successors are sorted directly, the rest are induced by scanning the buckets of first bytes.
   Adjacent common prefixes then tell which stretches are equal, and the smallest document of each. What is found in a
   representative holds for all places of its context.

Anchors that a bounded sample shows to be in many documents are not grouped by k-gram: their stretches travel one by one, so that no
group is large; the sample grows with the documents. It decides only how work is split, never what is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk
from .cluster import buckets_for, by, keyed_docs, part_of, settle

LENGTH = 50
GRAM = 20
HOT_SAMPLE, HOT_PART = 4_000, 256  # documents, at least, and one in so many
LAST = np.iinfo(np.int64).max  # stands for a null id: larger than all


# -- two-stage sorting


def _words8(t: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number, zeros past the end."""
    x = np.zeros(len(t) + 8, np.uint64)
    x[: len(t)] = t
    out = np.zeros(len(t), np.uint64)
    for j in range(8):
        out |= x[j : j + len(t)] << tk.U64(56 - 8 * j)
    return out


def smaller_than_successor(t: np.ndarray) -> np.ndarray:
    """For each suffix whether it is smaller than the suffix that begins one later; the end is smaller than any byte."""
    n = len(t)
    if not n:
        return np.zeros(0, bool)
    change = np.append(np.flatnonzero(t[1:] != t[:-1]) + 1, n)
    nxt = change[np.searchsorted(change, np.arange(n), side="right")]
    return np.append(t, 0)[nxt].astype(np.int16) * (nxt < n) - (nxt == n) > t.astype(np.int16)


def two_stage_sort(t: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of the bytes t, in order by at least the first `depth` bytes of each suffix.

    The suffixes smaller than their successors are sorted directly, eight bytes at a time and only while they tie; all others are
    induced: buckets of first bytes are scanned in ascending order, and each suffix found passes its predecessor on to its bucket.
    """
    n = len(t)
    small = smaller_than_successor(t)
    w = _words8(t)
    direct = np.flatnonzero(small)
    order = direct[np.argsort(w[direct], kind="stable")]
    key = w[order]
    tied_at = np.arange(0)
    if len(order):
        same = np.concatenate(([False], key[1:] == key[:-1]))
        group = np.cumsum(~same) - 1
        size = np.bincount(group)
        tied_at = np.flatnonzero(size[group] > 1)
    at = 8
    while at < depth and len(tied_at):
        g = group[tied_at]
        s = order[tied_at]
        k = np.where(s + at < n, w[np.minimum(s + at, n - 1)], tk.U64(0))
        o = np.argsort(k, kind="stable")
        o = o[np.argsort(g[o], kind="stable")]
        s, k, g = s[o], k[o], g[o]
        order[tied_at] = s
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])))
        sub = np.cumsum(new) - 1
        size = np.bincount(sub)
        keep = size[sub] > 1
        group[tied_at] = sub
        tied_at = tied_at[keep]
        at += 8
    # induce the larger ones
    first = t[order]
    cut = np.searchsorted(first, np.arange(257))
    lists: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []

    def hand_on(found: np.ndarray, least: int) -> None:
        p = found[found > 0] - 1
        p = p[~small[p] & (t[p] > least)]
        if len(p):
            c = t[p]
            o = np.argsort(c, kind="stable")
            p, c = p[o], c[o]
            edge = np.searchsorted(c, np.arange(257))
            for b in np.unique(c).tolist():
                lists[b].append(p[edge[b] : edge[b + 1]])

    if n:  # the last suffix follows the empty one, and is larger
        lists[int(t[-1])].append(np.array([n - 1]))
    for c in range(256):
        front = np.concatenate(lists[c]) if lists[c] else np.zeros(0, np.int64)
        parts = [front]
        while len(front):
            p = front[front > 0] - 1
            front = p[~small[p] & (t[p] == c)]
            parts.append(front)
        parts.append(order[cut[c] : cut[c + 1]])
        bucket = np.concatenate(parts)
        hand_on(bucket, c)
        out.append(bucket)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def adjacent_common(t: np.ndarray, sa: np.ndarray, depth: int, w: np.ndarray | None = None) -> np.ndarray:
    """Length of the common prefix of each suffix of sa with the one before it, at most depth; 0 for the first."""
    w = _words8(t) if w is None else w
    n, out = len(t), np.zeros(len(sa), np.int64)
    alive = np.arange(1, len(sa))
    at = 0
    while at < depth and len(alive):
        a, b = sa[alive] + at, sa[alive - 1] + at
        x = np.where(a < n, w[np.minimum(a, n - 1)], 0).astype(np.uint64) ^ np.where(b < n, w[np.minimum(b, n - 1)], 0).astype(np.uint64)
        lead = np.full(len(x), 8)
        nz = x != 0
        lead[nz] = 7 - (np.floor(np.log2(x[nz].astype(np.float64))).astype(np.int64) >> 3)
        # a rounded-up logarithm may name the next byte
        hi = np.clip(lead, 0, 7).astype(np.uint64)
        wrong = nz & ((x >> ((tk.U64(7) - hi) * tk.U64(8))) == 0)
        lead[wrong] += 1
        out[alive] += np.minimum(lead, n - np.maximum(a, b))
        alive = alive[lead == 8]
        at += 8
    return np.minimum(out, depth)


# -- anchors


def _slide(x: np.ndarray, w: int, f: np.ufunc) -> np.ndarray:
    """f over x[i:i+w] for every i that has them all."""
    have, m = 1, x
    while have < w:
        step = min(have, w - have)
        m = f(m[: len(m) - step], m[step:])
        have += step
    return m


def anchors(p: tk.Piece, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(position, hash of its k-gram, text) of the anchors of a piece: of the k-grams within any `length` bytes of a text, those of least hash."""
    buf = p.buf
    pre = tk.prefix_hash(buf)
    n = len(buf) - gram + 1
    w = length - gram + 1
    none = np.zeros(0, np.int64)
    if n < w:
        return none, none.astype(np.uint64), none
    i = np.arange(n)
    h = tk.span_hash(pre, i, i + gram)
    bad = np.zeros(len(buf) + 1, np.int32)
    bad[p.end] += 1  # the separators
    bad = np.cumsum(bad)
    ok = bad[i + gram - 1] == np.concatenate(([0], bad))[i]
    key = np.where(ok, (h >> tk.U64(32)).astype(np.uint32), np.uint32(0xFFFFFFFF))
    low = _slide(key, w, np.minimum)
    padded = np.concatenate((np.zeros(w - 1, np.uint32), low, np.zeros(w - 1, np.uint32)))
    at = np.flatnonzero(ok & (key == _slide(padded, w, np.maximum)))
    doc = p.doc_of(at)
    return at, h[at], doc


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each start, n of each, one range after the other."""
    n = n.astype(np.int64)
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _width(length: int, gram: int) -> str:
    """The type that holds the lengths of contexts."""
    return "u1" if 2 * length - gram < 256 else "u2"


def _least_per_group(h: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each entry the smallest id among entries of equal hash."""
    order, heads = tk.group_ids(h)
    least = np.minimum.reduceat(ids[order], heads) if len(heads) else ids
    out = np.empty_like(ids)
    out[order] = np.repeat(least, np.diff(np.append(heads, len(order))))
    return out


def _merge(key: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The unions of intervals [a, b) of each key."""
    if not len(key):
        return key, a, b
    o = np.lexsort((a, key))
    key, a, b = key[o], a[o].astype(np.int64), b[o].astype(np.int64)
    new = np.concatenate(([True], key[1:] != key[:-1]))
    g = np.cumsum(new) - 1
    big = int(b.max()) + 2
    reach = np.maximum.accumulate(b + g * big) - g * big
    start = new | np.concatenate(([True], a[1:] > reach[:-1]))
    s = np.flatnonzero(start)
    return key[s], a[s], np.maximum.reduceat(b, s)


SPANS = "part int, keys binary, a binary, b binary"


def _span_rows(key: np.ndarray, a: np.ndarray, b: np.ndarray, parts: int) -> list[tuple]:
    """Merged intervals by document bucket, as rows of `SPANS`."""
    key, a, b = _merge(key, a, b)
    part = (key.view(np.uint64) % tk.U64(parts)).astype(np.int64)
    o = np.argsort(part, kind="stable")
    key, a, b, part = key[o], a[o], b[o], part[o]
    u, s = np.unique(part, return_index=True)
    e = np.append(s[1:], len(part))
    return [(int(x), key[i:j].astype("i8").tobytes(), a[i:j].astype("u4").tobytes(), b[i:j].astype("u4").tobytes()) for x, i, j in zip(u, s, e)]


ENTRY = "kind int, bucket int, part int, keys binary, ids binary, doc binary, h binary, gram binary, a binary, b binary"
_ENTRY = [x.split(" ") for x in ENTRY.split(", ")]
_PA = {"int": pa.int32(), "binary": pa.binary(), "long": pa.int64()}


def _batch(rows: list[dict], fields: list[list[str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], _PA[k]) for n, k in fields], [n for n, _ in fields])


def _emit(d: DataFrame, buckets: int, parts: int, length: int, gram: int, hot: np.ndarray) -> DataFrame:
    """Anchors by bucket (kind 0), stretches of hot anchors by bucket (kind 1), and intervals already known within the task (kind 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in tk.slices(b)):
            keys = np.asarray(batch.column("key")).astype(np.int64)
            ids = np.asarray(batch.column("doc_id").fill_null(LAST)).astype(np.int64)
            got: dict[int, list] = {0: [], 1: []}
            for p in tk.pieces(batch):
                at, g, doc = anchors(p, length, gram)
                reach = length - gram
                a, b = np.maximum(at - reach, p.start[doc]), np.minimum(at + length, p.end[doc])
                keep = b - a >= length
                at, g, doc, a, b = at[keep], g[keep], doc[keep], a[keep], b[keep]
                pre = tk.prefix_hash(p.buf)
                is_hot = np.isin(g, hot) if len(hot) else np.zeros(len(g), bool)
                if is_hot.any():
                    n = b[is_hot] - a[is_hot] - length + 1
                    s = np.repeat(a[is_hot] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
                    s, one = np.unique(s, return_index=True)
                    dd = np.repeat(doc[is_hot], n)[one]
                    x = tk.span_hash(pre, s, s + length)
                    got[1].append((x, x, dd + p.row, s - p.start[dd], s + length - p.start[dd]))
                    at, g, doc, a, b = (v[~is_hot] for v in (at, g, doc, a, b))
                got[0].append((tk.span_hash(pre, a, b), g, doc + p.row, a - p.start[doc], b - p.start[doc]))
            for kind, parts_ in got.items():
                if not parts_:
                    continue
                x, g, doc, a, b = (np.concatenate(v) for v in zip(*parts_))
                known = _least_per_group(x, ids[doc]) < ids[doc]
                rows = [dict(kind=2, bucket=q % buckets, part=q, keys=k, a=s, b=e) for q, k, s, e in _span_rows(keys[doc[known]], a[known], b[known], parts)]
                x, g, doc, a, b = (v[~known] for v in (x, g, doc, a, b))
                at_bucket = ((g >> tk.U64(32)) % tk.U64(buckets)).astype(np.int64)
                o = np.argsort(at_bucket, kind="stable")
                for q, m, n in tk.runs(at_bucket[o]):
                    i = o[m:n]
                    u, inv = np.unique(doc[i], return_inverse=True)
                    rows.append(dict(kind=kind, bucket=q, part=-1, keys=keys[u].astype("i8").tobytes(), ids=ids[u].astype("i8").tobytes(), doc=tk.squeeze(inv), h=x[i].tobytes(), gram=g[i].astype("u4").tobytes(), a=tk.squeeze(a[i]), b=(b[i] - a[i]).astype(_width(length, gram)).tobytes()))
                if rows:
                    yield _batch(rows, _ENTRY)

    return d.mapInArrow(run, ENTRY)


DECIDED = "kind int, part int, keys binary, a binary, b binary, gram binary, ids binary, more binary, also binary, at binary"
_DECIDED = [x.split(" ") for x in DECIDED.split(", ")]


def _decide(entries: DataFrame, buckets: int, parts: int, width: str) -> DataFrame:
    """Per bucket: intervals found in smaller documents, there or before (kind 2), and the representatives of contexts that share an anchor (kind 3).

    more: how many other places have the context of each representative; also, at: the documents and positions of those.
    """

    def run(t: pa.Table) -> pa.Table:
        sent = t.select([n for n, _ in _ENTRY]).to_pylist()
        rows = [dict(kind=2, part=r["part"], keys=r["keys"], a=r["a"], b=r["b"]) for r in sent if r["kind"] == 2]
        for kind in (0, 1):
            cols = []
            for r in sent:
                if r["kind"] == kind:
                    doc = tk.unsqueeze(r["doc"])
                    cols.append((np.frombuffer(r["keys"], "i8")[doc], np.frombuffer(r["ids"], "i8")[doc], np.frombuffer(r["h"], "u8"), np.frombuffer(r["gram"], "u4"), tk.unsqueeze(r["a"]), np.frombuffer(r["b"], width)))
            if not cols:
                continue
            key, ids, h, gram, a, b = (np.concatenate(c) for c in zip(*cols))
            b = a + b
            least = _least_per_group(h, ids)
            known = least < ids
            rows += [dict(kind=2, part=q, keys=k, a=s, b=e) for q, k, s, e in _span_rows(key[known], a[known], b[known], parts)]
            if kind == 0:
                # one of each context, where its anchor is in other documents too; a context at the edge of a text can have several anchors
                i = np.flatnonzero(~known)
                every = i[np.lexsort((a[i], key[i], gram[i], h[i]))]
                new = np.concatenate(([True], (h[every][1:] != h[every][:-1]) | (gram[every][1:] != gram[every][:-1]))) if len(every) else np.zeros(0, bool)
                head = np.flatnonzero(new)
                count = np.diff(np.append(head, len(every))) - 1
                o = every[head]
                lo, hi = _least_per_group(gram[o], ids[o]), -_least_per_group(gram[o], -ids[o])
                o, head, count = o[lo < hi], head[lo < hi], count[lo < hi]
                q = (key[o].view(np.uint64) % tk.U64(parts)).astype(np.int64)
                by_part = np.argsort(q, kind="stable")
                o, head, count = o[by_part], head[by_part], count[by_part]
                q = np.sort(q)
                u, s = np.unique(q, return_index=True)
                for x, m, n in zip(u, s, np.append(s[1:], len(q))):
                    j = o[m:n]
                    rest = every[_ranges(head[m:n] + 1, count[m:n])]
                    rows.append(dict(kind=3, part=int(x), keys=key[j].astype("i8").tobytes(), a=a[j].astype("u4").tobytes(), b=b[j].astype("u4").tobytes(), gram=gram[j].astype("u4").tobytes(), ids=ids[j].astype("i8").tobytes(), more=count[m:n].astype("u4").tobytes(), also=key[rest].astype("i8").tobytes(), at=a[rest].astype("u4").tobytes()))
        return pa.Table.from_batches([_batch(rows, _DECIDED)])

    return by(entries, buckets, "bucket").applyInArrow(run, DECIDED)


CONTEXT = "bucket int, keys binary, ids binary, a binary, n binary, gram binary, bytes binary, more binary, also binary, at binary"
_CONTEXT = [x.split(" ") for x in CONTEXT.split(", ")]


def _fetch(d: DataFrame, decided: DataFrame, parts: int, buckets: int, width: str) -> DataFrame:
    """The bytes of the wanted contexts, by anchor bucket: a row for each part and bucket, as there are many of them."""

    def run(texts: pa.Table, wanted: pa.Table) -> pa.Table:
        rows: dict[int, dict[str, list[bytes]]] = {}
        w = wanted.to_pylist()
        if w and texts.num_rows:
            key, ids, a, b, gram, more, also, at = (np.concatenate([np.frombuffer(r[c], k) for r in w]) for c, k in (("keys", "i8"), ("ids", "i8"), ("a", "u4"), ("b", "u4"), ("gram", "u4"), ("more", "u4"), ("also", "i8"), ("at", "u4")))
            rest = np.cumsum(more, dtype=np.int64) - more
            here = np.asarray(texts.column("key").combine_chunks()).astype(np.int64)
            o = np.argsort(here, kind="stable")
            row = o[np.minimum(np.searchsorted(here[o], key), len(o) - 1)]
            for p in tk.pieces(texts.select(["doc_id", "text"])):
                mine = np.flatnonzero((row >= p.row) & (row < p.row + len(p.start)))
                if not len(mine):
                    continue
                mine = mine[np.argsort(gram[mine] % np.uint32(buckets), kind="stable")]
                base = p.start[row[mine] - p.row]
                s, n = base + a[mine], (b[mine] - a[mine]).astype(np.int64)
                q = gram[mine] % np.uint32(buckets)
                for x in np.unique(q):
                    i, j = np.searchsorted(q, x), np.searchsorted(q, x, side="right")
                    k = n[i:j]
                    pos = _ranges(s[i:j], k)
                    m = mine[i:j]
                    e = _ranges(rest[m], more[m])
                    sent = dict(keys=key[m], ids=ids[m], a=a[m], n=k.astype(width), gram=gram[m], bytes=p.buf[pos], more=more[m], also=also[e], at=at[e])
                    to = rows.setdefault(int(x), {c: [] for c in sent})
                    for c, v in sent.items():
                        to[c].append(v.tobytes())
        return pa.Table.from_batches([_batch([dict(bucket=x, **{c: b"".join(v) for c, v in r.items()}) for x, r in rows.items()], _CONTEXT)])

    return by(d.withColumn("part", part_of(parts)), parts, "part").cogroup(by(decided.where("kind = 3"), parts, "part")).applyInArrow(run, CONTEXT)


def _compare(contexts: DataFrame, buckets: int, parts: int, length: int, width: str) -> DataFrame:
    """Intervals that suffix arrays of the contexts find in smaller documents."""

    def run(t: pa.Table) -> pa.Table:
        w = t.to_pylist()
        key, ids, a, n, gram, text, more, also, at = (np.concatenate([np.frombuffer(r[c], k) for r in w]) for c, k in (("keys", "i8"), ("ids", "i8"), ("a", "u4"), ("n", width), ("gram", "u4"), ("bytes", "u1"), ("more", "u4"), ("also", "i8"), ("at", "u4")))
        n = n.astype(np.int64)
        rest = np.cumsum(more, dtype=np.int64) - more
        # whole anchor groups at a time, some megabytes each
        o = np.argsort(gram, kind="stable")
        starts = np.concatenate(([0], np.cumsum(n)))[:-1]
        heads = np.flatnonzero(np.concatenate(([True], gram[o][1:] != gram[o][:-1])))
        upto = np.concatenate(([0], np.cumsum(n[o] + 1)))
        found, i = [], 0
        while i < len(o):
            j = heads[np.searchsorted(heads, i, side="right") :]
            fit = j[upto[j] - upto[i] <= 4 << 20]
            e = int(fit[-1]) if len(fit) else int(j[0]) if len(j) else len(o)
            if len(j) == 0 or (len(fit) == len(j) and upto[-1] - upto[i] <= 4 << 20):
                e = len(o)
            m = o[i:e]
            k = n[m]
            s = np.concatenate(([0], np.cumsum(k + 1)))[:-1]
            t8 = np.full(int((k + 1).sum()), 0xFF, np.uint8)
            own = np.repeat(np.arange(len(m)), k)
            off = np.arange(k.sum()) - np.repeat(np.concatenate(([0], np.cumsum(k)[:-1])), k)
            t8[s[own] + off] = text[starts[m][own] + off]
            sa = two_stage_sort(t8, length)
            c = np.searchsorted(s, sa, side="right") - 1
            ok = sa + length <= s[c] + k[c]
            sa, c = sa[ok], c[ok]
            if len(sa):
                head = adjacent_common(t8, sa, length) < length
                h = np.flatnonzero(head)
                least = np.repeat(np.minimum.reduceat(ids[m[c]], h), np.diff(np.append(h, len(sa))))
                hit = least < ids[m[c]]
                # what is found in a context overlaps, so it is one interval; it holds at every place of the context
                order, h = tk.group_ids(m[c[hit]])
                if len(h):
                    off, r = (sa[hit] - s[c[hit]])[order], m[c[hit]][order][h]
                    lo, hi = np.minimum.reduceat(off, h), np.maximum.reduceat(off, h) + length
                    other, k = _ranges(rest[r], more[r]), more[r]
                    x, y = np.concatenate((key[r], also[other])), np.concatenate((a[r], at[other])).astype(np.int64)
                    found.append((x, y + np.concatenate((lo, np.repeat(lo, k))), y + np.concatenate((hi, np.repeat(hi, k)))))
            i = e
        rows = []
        if found:
            x, y, z = (np.concatenate(v) for v in zip(*found))
            rows = [dict(part=q, keys=kk, a=aa, b=bb) for q, kk, aa, bb in _span_rows(x, y, z, parts)]
        return pa.Table.from_batches([_batch(rows, [f.split(" ") for f in SPANS.split(", ")])])

    return by(contexts, buckets, "bucket").applyInArrow(run, SPANS)


def _cut_out(d: DataFrame, spans: DataFrame, parts: int, texts_too: bool) -> DataFrame:
    schema = "doc_id long, key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", text string" if texts_too else "")

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        cols: list[list] = [[] for _ in range(7)]
        w = found.to_pylist()
        key, a, b = (np.concatenate([np.frombuffer(r[c], k) for r in w]) if w else np.zeros(0, np.int64) for c, k in (("keys", "i8"), ("a", "u4"), ("b", "u4")))
        key, a, b = _merge(key, a, b)
        keys = texts.column("key").to_pylist()
        for p in tk.pieces(texts.select(["doc_id", "text"])):
            for k, i in enumerate(p.ids.to_pylist()):
                x, y = np.searchsorted(key, keys[p.row + k]), np.searchsorted(key, keys[p.row + k], side="right")
                whole = p.text(k)
                left = whole
                if y > x:
                    cuts = zip([0, *b[x:y].tolist()], [*a[x:y].tolist(), len(whole)])
                    left = b"".join(whole[m:n] for m, n in cuts)
                for c, v in zip(cols, (i, keys[p.row + k], len(whole), len(whole) - len(left), int(y - x), hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace") if texts_too else None)):
                    c.append(v)
        types = [pa.int64()] * 5 + [pa.string()] * 2
        names = ["doc_id", "key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
        return pa.table({n: pa.array(c, t) for n, c, t in list(zip(names, cols, types))[: 7 if texts_too else 6]})

    return by(d.withColumn("part", part_of(parts)), parts, "part").cogroup(by(spans, parts, "part")).applyInArrow(run, schema)


def hot_anchors(d: DataFrame, length: int, gram: int, sample: int = HOT_SAMPLE, part: int = HOT_PART) -> np.ndarray:
    """Hashes of anchors in many documents, from a sample by key of `sample` documents or a part-th of all, if that is more.

    Many is 20 of the sample, or a 2**-20 of its anchors, if that is more: so at most 2**20 are hot, and any other is expected in fewer
    than 20 * part documents or a 2**-20 of all anchors.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in tk.pieces(batch):
                _, g, doc = anchors(p, length, gram)
                _, one = np.unique(tk.mix(g ^ tk.mix(doc.astype(np.uint64))), return_index=True)
                u, n = np.unique(g[one], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n)], ["g", "n"])

    total = d.count()
    share = max(sample, total // part) / max(total, 1)
    some = d.where(F.shiftrightunsigned("key", 1) < int(share * (1 << 63))) if share < 1 else d
    counts = settle(some.select("doc_id", "text").mapInArrow(run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")), "anchor-counts", free=False)
    least = max(20, (counts.agg(F.sum("n")).first()[0] or 0) >> 20)
    return np.sort(np.array([r[0] for r in counts.where(F.col("n") >= least).select("g").collect()], np.int64).view(np.uint64))


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, texts_too: bool = False) -> DataFrame:
    """A row for each row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked for, text, what is left of it.

    A byte goes if a string of `length` bytes that covers it also starts in a row with a smaller id (judged on the input). Null texts
    are empty; texts shorter than length lose nothing; null ids are larger than all others, and rows of equal id never remove each
    other's bytes; an empty table gives an empty one; other columns are ignored. What is left may be cut within a character; in text
    such pieces become replacement characters, kept_sha256 is of the bytes.
    """
    if length > 200 or not 8 <= gram <= length:
        raise ValueError("8 <= gram <= length <= 200")
    d = keyed_docs(docs, id_col, text_col)
    # each part sends a row to each bucket, so rows grow with the square of the input: contexts, of which there are fewer than anchors, go to fewer buckets
    parts, buckets, few = buckets_for(docs, 4 << 20), buckets_for(docs, 8 << 20), buckets_for(docs, 16 << 20)
    hot, width = hot_anchors(d, length, gram), _width(length, gram)
    decided = settle(_decide(_emit(d, buckets, parts, length, gram, hot), buckets, parts, width), "anchors-decided")
    more = settle(_compare(_fetch(d, decided, parts, few, width), few, parts, length, width), "anchors-compared")
    spans = decided.where("kind = 2").select("part", "keys", "a", "b").unionByName(more)
    return _cut_out(d, spans, parts, texts_too).drop("key")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, repeats of 50 bytes removed."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT doc_id, h, length(h) // 2 AS n FROM d),
w AS (SELECT doc_id, n, unnest(generate_series(0, n - 50)) AS p, h FROM b WHERE n >= 50),
s AS (SELECT doc_id, p, md5_number(substr(h, 2 * p + 1, 100)) AS x FROM w),
m AS (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY x) AS first FROM s),
c AS (SELECT doc_id, p FROM m WHERE first < doc_id),
g AS (SELECT doc_id, p, CASE WHEN p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) <= 50 THEN 0 ELSE 1 END AS new FROM c),
r AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
i AS (SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM r GROUP BY doc_id, run),
k AS (SELECT doc_id, run, z AS a, lead(a) OVER (PARTITION BY doc_id ORDER BY run) AS z FROM i UNION ALL SELECT doc_id, 0, 0, min(a) FROM i GROUP BY doc_id),
t AS (SELECT k.doc_id, string_agg(substr(b.h, 2 * k.a + 1, 2 * (coalesce(k.z, b.n) - k.a)), '' ORDER BY run) AS kept FROM k JOIN b USING (doc_id) GROUP BY k.doc_id),
q AS (SELECT doc_id, sum(z - a) AS n_removed, count(*) AS n_spans FROM i GROUP BY doc_id)
SELECT b.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM b LEFT JOIN q USING (doc_id) LEFT JOIN t USING (doc_id)
"""
