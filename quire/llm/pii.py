"""Personal data by patterns and a skip-chain conditional random field.

The base patterns (email, ip, card, phone) are matched exactly as over the whole text, but only inside the maximal runs of bytes that
could hold a match, which numpy finds. The random field then labels every token that has a digit, '@' or '+'. Its edges join
neighbouring tokens (chain), successive occurrences of one token (apart from marks around it), and successive tokens of one shape in
the same document (skip edges, however far apart); loopy sum-product message passing runs over all documents of a piece at once, with
the tokens of base spans held at their label. Tokens whose marginal for a kind reaches `CERTAIN` add spans; base spans always stay.
So a number without its prefix, or with other separators, is found where the document has it in full elsewhere.

There are no annotated spans, so the weights are fitted by pseudo-likelihood on base spans as if they were hidden: half of the time
what a token looks like is masked, half of the time what stands around it, and half of the time its neighbours' labels, so that each
must do without the others. Tokens in no base span are examples of nothing, so that looks alone rarely decide where they are shared; numbers that fail
the test of their kind (Luhn's, 255) have a look of their own, and the field leaves them alone. The fit is on
whole documents, those whose ids hash lowest, at most `FIT_DOCS` and with at most `FIT_TOKENS` such tokens together. Everything else
covers every whole text, in one pass without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk
from .cluster import discard, settle

KINDS = ("email", "ip", "card", "phone")
L = len(KINDS) + 1  # label 0: none
EMAIL = re.compile(rb"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(rb"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(rb"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")
FIT_DOCS = 20_000
FIT_TOKENS = 400_000
CERTAIN = 0.9
DIM = 1 << 15
OWN = 5  # the first features: what the token itself looks like
MASKED = DIM - 1  # stands for each of them where they are masked, and MASKED - 1 for each of the others
ROUNDS = 8
_D = tk.table((0x30, 0x39))
_chars = lambda s: tk.table(*[(ord(c), ord(c)) for c in s])
_ALNUM = tk.table((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))
_EMAIL_RUN = _ALNUM | _chars("._%+-@")
_IP_RUN = _D | _chars(".")
_CARD_RUN = _D | _chars(" -")
_PHONE_RUN = _D | _chars(" ().-")
_MARK = _D | _chars("@+")
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[_D] = ord("9")
_SHAPE[tk.table((0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))] = ord("a")
_EDGE_CHARS = _ALNUM | _chars("+()") | tk.table((0x80, 0xFF))


def luhn(digits: bytes) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = c - 48
        if k % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _digits(s: bytes) -> bytes:
    return bytes(c for c in s if 48 <= c <= 57)


def accepted(kind: int, s: bytes) -> bool:
    """Whether a match of a kind's pattern passes its test."""
    if kind == 0:
        return True
    if kind == 1:
        return all(len(x.lstrip(b"0")) <= 3 and int(x) <= 255 for x in s.split(b"."))
    n = _digits(s)
    return 14 <= len(n) <= 19 and luhn(n) if kind == 2 else 10 <= len(n) <= 15


def rejected(token: bytes) -> bool:
    """Whether a token is a number as long as a card's that fails Luhn's test, or four numbers with dots of which one is too large."""
    n = _digits(token)
    if re.fullmatch(rb"[0-9 -]+", token):
        return 14 <= len(n) <= 19 and not luhn(n)
    return IP.fullmatch(token) is not None and not accepted(1, token)


def base_spans(buf: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base matches in a buffer of texts whose separators no pattern crosses, by start, then kind."""
    out = []
    total = np.concatenate(([0], np.cumsum(_D[buf], dtype=np.int32)))

    def scan(kind: int, pattern: re.Pattern, starts: np.ndarray, ends: np.ndarray) -> None:
        for a, b in zip(starts.tolist(), ends.tolist()):
            for m in pattern.finditer(buf[a:b].tobytes()):
                if accepted(kind, m.group()):
                    out.append((a + m.start(), a + m.end(), kind))

    at = np.flatnonzero(buf == ord("@"))
    if len(at):
        a, b = tk.spans(_EMAIL_RUN[buf])
        k = np.unique(np.searchsorted(a, at, side="right") - 1)
        scan(0, EMAIL, a[k], b[k])
    a, b = tk.spans(_IP_RUN[buf])
    k = np.flatnonzero(b - a >= 7)
    if len(k):
        k = k[(b[k] - a[k]) - (total[b[k]] - total[a[k]]) >= 3]
        scan(1, IP, a[k], b[k])
    a, b = tk.spans(_CARD_RUN[buf])
    k = np.flatnonzero(b - a >= 14)
    if len(k):
        k = k[total[b[k]] - total[a[k]] >= 14]
        scan(2, CARD, a[k], b[k])
    at = np.flatnonzero(buf[:-1] == ord("+"))
    at = at[_D[buf[at + 1]]]
    if len(at):
        a, b = tk.spans(_PHONE_RUN[buf])
        k = np.searchsorted(a, at + 1, side="right") - 1
        scan(3, PHONE, at, b[k])
    return sorted(out, key=lambda s: (s[0], s[2], s[1]))


@dataclass
class Graph:
    """The tokens of a piece that may be personal data, and the edges between them."""

    start: np.ndarray
    end: np.ndarray
    word: np.ndarray
    doc: np.ndarray
    features: np.ndarray
    edges: list[np.ndarray]  # by type: chain, same token, same shape; rows (i, j)
    label: np.ndarray  # of the base span over the token, else 0


def build_graph(p: tk.Piece, spans: list[tuple[int, int, int]]) -> Graph | None:
    buf = p.buf
    marks = np.flatnonzero(_MARK[buf])
    if not len(marks):
        return None
    a, b, first = tk.words(p)
    k = np.unique(np.searchsorted(a, marks, side="right") - 1)
    doc = np.searchsorted(first, k, side="right") - 1
    shape_pre = tk.prefix_hash(_SHAPE[buf])
    pre = tk.prefix_hash(buf)
    word_shape = lambda i: np.where((i >= 0) & (i < len(a)), tk.span_hash(shape_pre, a[np.clip(i, 0, len(a) - 1)], b[np.clip(i, 0, len(a) - 1)]), tk.U64(7))
    digits, dots = np.concatenate(([0], np.cumsum(_D[buf], dtype=np.int32))), np.flatnonzero(buf == ord("."))
    word = lambda i: np.where((i >= 0) & (i < len(a)), tk.span_hash(pre, a[np.clip(i, 0, len(a) - 1)], b[np.clip(i, 0, len(a) - 1)]), tk.U64(9))
    # a token apart from marks around it
    x, y = a[k].copy(), b[k].copy()
    for _ in range(4):
        x += (y - x > 1) & ~_EDGE_CHARS[buf[x]]
        y -= (y - x > 1) & ~_EDGE_CHARS[buf[y - 1]]
    h, s = tk.span_hash(pre, x, y), tk.span_hash(shape_pre, x, y)
    # what would be of a kind but fails its test does not look like that kind
    for i in np.flatnonzero((digits[y] - digits[x] >= 14) | ((np.searchsorted(dots, y) - np.searchsorted(dots, x)) >= 3)).tolist():
        if rejected(buf[x[i] : y[i]].tobytes()):
            s[i] ^= tk.U64(11)
    nd = digits[y] - digits[x]
    has = lambda c: (np.searchsorted(at := np.flatnonzero(buf == ord(c)), y) - np.searchsorted(at, x)).astype(np.int64)
    size = np.minimum(y - x, 40)
    own = [s, size.astype(tk.U64) * tk.U64(64) + np.minimum(nd, 40).astype(tk.U64), np.minimum(has("@"), 2).astype(tk.U64) * tk.U64(3) + (_SHAPE[buf[x]]).astype(tk.U64) * tk.U64(16), np.minimum(has("."), 6).astype(tk.U64) * tk.U64(128) + np.minimum(nd, 20).astype(tk.U64), np.minimum(has("-") + has("("), 4).astype(tk.U64) * tk.U64(64) + np.minimum(nd, 20).astype(tk.U64)]
    around = [word_shape(k - 1) ^ tk.U64(3), word_shape(k + 1) ^ tk.U64(5), word(k - 1), word(k + 1)]
    features = np.stack([np.minimum(tk.mix(c + tk.U64(1000003 * (i + 1))) & tk.U64(DIM - 1), tk.U64(MASKED - 2)).astype(np.int32) for i, c in enumerate(own + around)], axis=1)
    edges = []
    near = np.flatnonzero((doc[1:] == doc[:-1]) & (k[1:] - k[:-1] <= 2))
    edges.append(np.stack([near, near + 1], axis=1))
    for key in (h, s):
        order = np.lexsort((k, key, doc))
        j = np.flatnonzero((key[order][1:] == key[order][:-1]) & (doc[order][1:] == doc[order][:-1]))
        edges.append(np.stack([order[j], order[j + 1]], axis=1))
    same = {(i, j) for i, j in edges[1].tolist()}
    if same:
        edges[2] = np.array([e for e in edges[2].tolist() if tuple(e) not in same], np.int64).reshape(-1, 2)
    label = np.zeros(len(k), np.int64)
    for x, y, kind in spans:
        i = np.searchsorted(b[k], x, side="right")
        while i < len(k) and a[k[i]] < y:
            label[i] = label[i] or kind + 1
            i += 1
    return Graph(a[k], b[k], k, doc, features, edges, label)


@dataclass
class Field:
    """Weights: of node features (DIM, L) and, by edge type, of label pairs (3, L, L)."""

    node: np.ndarray
    pair: np.ndarray


def marginals(g: Graph, f: Field, rounds: int = ROUNDS) -> np.ndarray:
    """Label marginals by loopy sum-product with damping; tokens with a base label are held at it."""
    n = len(g.start)
    unary = f.node[g.features].sum(axis=1)
    held = g.label > 0
    unary[held] = -30.0
    unary[held, g.label[held]] = 0.0
    src = np.concatenate([x for e in g.edges for x in (e[:, 0], e[:, 1])])
    dst = np.concatenate([x for e in g.edges for x in (e[:, 1], e[:, 0])])
    pair = np.concatenate([np.repeat(x[None], len(e), axis=0) for t, e in enumerate(g.edges) for x in (f.pair[t], f.pair[t].T)]) if len(src) else np.zeros((0, L, L))
    half = [len(e) for e in g.edges]
    back, at = np.empty(len(src), np.int64), 0
    for m in half:
        back[at : at + m], back[at + m : at + 2 * m] = np.arange(at + m, at + 2 * m), np.arange(at, at + m)
        at += 2 * m
    msg = np.zeros((len(src), L))
    for _ in range(rounds if len(src) else 0):
        belief = unary + np.stack([np.bincount(dst, msg[:, c], minlength=n) for c in range(L)], axis=1)
        out = (belief[src] - msg[back])[:, :, None] + pair
        top = out.max(axis=1, keepdims=True)
        new = (top + np.log(np.exp(out - top).sum(axis=1, keepdims=True)))[:, 0]
        msg = 0.5 * msg + 0.5 * (new - new.max(axis=1, keepdims=True))
    belief = unary + (np.stack([np.bincount(dst, msg[:, c], minlength=n) for c in range(L)], axis=1) if len(src) else 0)
    belief = np.exp(belief - belief.max(axis=1, keepdims=True))
    return belief / belief.sum(axis=1, keepdims=True)


def neighbour_counts(g: Graph) -> np.ndarray:
    """For each token and edge type, how many neighbours are in base spans of each kind; those in none are not known to be nothing."""
    out = np.zeros((len(g.start), 3, L), np.float32)
    for t, e in enumerate(g.edges):
        for i, j in ((0, 1), (1, 0)):
            np.add.at(out, (e[:, i], t, g.label[e[:, j]]), 1)
    out[:, :, 0] = 0
    return out


def fit_field(features: np.ndarray, neighbours: np.ndarray, label: np.ndarray, steps: int = 2_000, rate: float = 0.1, decay: float = 1e-5, seed: int = 1) -> Field:
    """Pseudo-likelihood of each label given the token's look, what is around it, and the neighbours' labels (AdaGrad; deterministic; whole epochs, at least 6, of at least `steps` steps together), each of the three masked half of the time. Without a base span the field is one that adds nothing."""
    node, pair = np.zeros((DIM, L)), np.zeros((3, L, L))
    if not label.any():
        node[:, 0] = 1.0
        return Field(node, pair)
    neighbours = np.minimum(neighbours, 2)
    rng = np.random.Generator(np.random.PCG64(seed))
    gn, gp = np.full(node.shape, 1e-6), np.full(pair.shape, 1e-6)
    onehot = np.eye(L)[label]
    for _ in range(max(6, -(-steps * 512 // len(label)) if len(label) > 512 else steps)):
        order = rng.permutation(len(label))
        for at in range(0, len(order), 512):
            i = order[at : at + 512]
            nb = neighbours[i] * (rng.random(len(i)) < 0.5)[:, None, None]
            f = features[i]
            for part, mask in ((slice(None, OWN), MASKED), (slice(OWN, None), MASKED - 1)):
                f[:, part] = np.where((rng.random(len(i)) < 0.5)[:, None], mask, f[:, part])
            z = node[f].sum(axis=1) + np.einsum("ntl,tlm->nm", nb, pair)
            p = np.exp(z - z.max(axis=1, keepdims=True))
            g = p / p.sum(axis=1, keepdims=True) - onehot[i]
            u, inv = np.unique(f, return_inverse=True)
            d = np.zeros((len(u), L))
            np.add.at(d, inv.reshape(f.shape), g[:, None, :])
            d = d / len(i) + decay * node[u]
            gn[u] += d * d
            node[u] -= rate * d / np.sqrt(gn[u])
            e = np.einsum("ntl,nm->tlm", nb, g) / len(i)
            e = e + e.transpose(0, 2, 1)  # one potential for both directions of an edge
            gp += e * e
            pair -= rate * e / np.sqrt(gp)
    return Field(node, pair)


def _plausible(kind: int, s: bytes) -> bool:
    n = len(_digits(s))
    if kind == 1:
        parts = re.findall(rb"[0-9]+", s)
        return len(parts) == 4 and all(int(x) <= 255 for x in parts) and not re.search(rb"[A-Za-z]", s)
    if kind == 2:
        return 14 <= n <= 19 and luhn(_digits(s))
    return b"@" in s if kind == 0 else 7 <= n <= 15


def added_spans(p: tk.Piece, g: Graph, m: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans of tokens that are almost surely of a kind, next to each other ones joined, ends trimmed, where no base span is."""
    label = np.where(m.max(axis=1) >= CERTAIN, m.argmax(axis=1), 0)
    out, i = [], 0
    ends = np.array([e for _, e, _ in base], np.int64)
    while i < len(label):
        if not label[i] or g.label[i]:
            i += 1
            continue
        j = i
        while j + 1 < len(label) and label[j + 1] == label[i] and not g.label[j + 1] and g.word[j + 1] == g.word[j] + 1 and g.doc[j + 1] == g.doc[i]:
            j += 1
        a, b = int(g.start[i]), int(g.end[j])
        good = np.flatnonzero(_EDGE_CHARS[p.buf[a:b]])
        if len(good):
            a, b = a + int(good[0]), a + int(good[-1]) + 1
            k = int(np.searchsorted(ends, a, side="right"))
            free = all(s >= b for s, _, _ in base[k : k + 1])
            if free and _plausible(label[i] - 1, p.buf[a:b].tobytes()):
                out.append((a, b, int(label[i]) - 1))
        i = j + 1
    return out


def piece_spans(p: tk.Piece, field: Field | None, base: list[tuple[int, int, int]] | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, added) spans of a piece as byte positions. base: the base spans that are known, if not all."""
    base = base_spans(p.buf) if base is None else base
    g = build_graph(p, base) if field is not None else None
    # a piece's base spans may overlap each other; `ends` needs order
    return base, added_spans(p, g, marginals(g, field), sorted(base, key=lambda s: s[1])) if g is not None else []


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, fit_tokens: int = FIT_TOKENS) -> Field:
    """A field from the base spans of at most fit_docs documents, in order of the hashes of their ids, that have at most fit_tokens tokens together; one that goes beyond is left out. A table without base spans gives a field that adds nothing; null ids are never used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in tk.pieces(batch):
                g = build_graph(p, base_spans(p.buf))
                if g is None:
                    continue
                nb = neighbour_counts(g).astype(np.int8)
                cut = np.searchsorted(g.doc, np.arange(len(p.start) + 1))
                keep = np.flatnonzero(np.diff(cut))
                blob = lambda x: pa.array([x[cut[d] : cut[d + 1]].tobytes() for d in keep], pa.binary())
                yield pa.RecordBatch.from_arrays([p.ids.take(pa.array(keep)), pa.array(np.diff(cut)[keep]), blob(g.features.astype("i4")), blob(nb), blob(g.label.astype(np.int8))], ["doc_id", "tokens", "f", "n", "y"])

    # bounded: fit_docs ids
    some = docs.where("doc_id IS NOT NULL").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(some), "doc_id")
    got = settle(rows.mapInArrow(run, "doc_id long, tokens long, f binary, n binary, y binary"), "pii-fit", free=False)
    chosen, total = [], 0
    for i, n in got.groupBy("doc_id").agg(F.sum("tokens").alias("n")).orderBy(F.xxhash64("doc_id"), "doc_id").collect():
        if total + n <= fit_tokens:
            chosen.append((i,))
            total += n
    told = got.join(F.broadcast(docs.sparkSession.createDataFrame(chosen, "doc_id long")), "doc_id").select("doc_id", "f", "n", "y").toPandas().sort_values(["doc_id", "f", "y"])
    discard(got)
    f, n, y = (np.frombuffer(b"".join(told[c]), t) for c, t in (("f", "i4"), ("n", np.int8), ("y", np.int8)))
    return fit_field(f.reshape(len(y), -1) if len(y) else np.zeros((0, 1), np.int32), n.reshape(-1, 3, L).astype(np.float32), y.astype(np.int64))


def recovery(docs: DataFrame, field: Field, share: int = 3) -> dict[str, int]:
    """How well the field finds base spans that it is not told: of documents with base spans every share-th span, by a hash, is hidden.

    hidden: spans hidden; found: those of which an added span of that kind covers all; added: spans added; right: those that touch a hidden span of their kind.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in tk.pieces(batch):
                base = base_spans(p.buf)
                h = tk.mix(np.array([a for a, _, _ in base], tk.U64)) % tk.U64(share) == 0
                hidden, seen = [x for x, y in zip(base, h) if y], [x for x, y in zip(base, h) if not y]
                _, added = piece_spans(p, field, seen)
                found = sum(any(x <= a and b <= y and k == j for x, y, j in added) for a, b, k in hidden)
                right = sum(any(x < b and a < y and k == j for x, y, j in hidden) for a, b, k in added)
                yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (len(hidden), found, len(added), right)], ["hidden", "found", "added", "right"])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    names = ["hidden", "found", "added", "right"]
    return source.mapInArrow(run, ", ".join(f"{c} long" for c in names)).agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names)).first().asDict()


def _told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], s[2], s[1])))


def _by_doc(p: tk.Piece, spans: list[tuple[int, int, int]], points: np.ndarray | None) -> list[list[tuple[int, int, int]]]:
    """Spans per text, relative to it; in code points if their running count is given."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in p.start]
    if spans:
        docs = p.doc_of(np.array([a for a, _, _ in spans]))
        for d, (a, b, k) in zip(docs.tolist(), spans):
            o = int(p.start[d])
            out[d].append((a - o, b - o, k) if points is None else (int(points[a] - points[o]), int(points[b] - points[o]), k))
    return out


def find(docs: DataFrame, field: Field | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (of the base spans) and spans (all), a row for each row of docs.

    Null and empty texts have no spans; null ids and repeated rows are kept; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in tk.pieces(batch):
                base, more = piece_spans(p, field)
                points = np.concatenate(([0], np.cumsum((p.buf & 0xC0) != 0x80, dtype=np.int64))) if base or more else None
                b, m = (_by_doc(p, s, points) for s in (base, more))
                counts = [pa.array([sum(k == c for _, _, k in x) for x in b], pa.int64()) for c in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [p.ids, *counts, pa.array([hashlib.sha256(_told(x).encode()).hexdigest() for x in b]), pa.array([_told(x + y) for x, y in zip(b, m)], pa.string())], ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
                )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redact(docs: DataFrame, field: Field | None, text_col: str = "text") -> DataFrame:
    """docs with every span in text_col replaced by <EMAIL>, <IP>, <CARD> or <PHONE>; overlapping spans are replaced as one, named after the first. Null texts stay null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = pa.RecordBatch.from_arrays([batch.column(0), pa.nulls(batch.num_rows)], ["text", "id"])
            changed: dict[int, str] = {}
            for p in tk.pieces(b, "id", "text"):
                base, more = piece_spans(p, field)
                for d, spans in enumerate(_by_doc(p, base + more, None)):
                    if spans:
                        text, out, at = p.text(d), [], 0
                        for x, y, k in sorted(spans, key=lambda s: (s[0], s[2])):
                            if x >= at:
                                out += [text[at:x], b"<" + KINDS[k].upper().encode() + b">"]
                            at = max(at, y)
                        changed[p.row + d] = b"".join([*out, text[at:]]).decode("utf-8", "replace")
            texts = batch.column(0)
            if changed:
                old = texts.to_pylist()
                texts = pa.array([changed.get(i, t) for i, t in enumerate(old)], pa.string())
            yield pa.RecordBatch.from_arrays([texts.cast(pa.string()), *batch.columns[1:]], batch.schema.names)

    rest = [c for c in docs.columns if c != text_col]
    source = docs.select(F.col(f"`{text_col}`").cast("string").alias("t"), *(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)))
    done = source.mapInArrow(run, source.schema)
    names = {c: f"c{i}" for i, c in enumerate(rest)} | {text_col: "t"}
    return done.select(*(F.col(names[c]).alias(c) for c in docs.columns))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return find(docs, fit(docs))


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op10 that the field has no part in."""
    return find(spark.read.parquet(f"{sf_dir}/documents.parquet"), None).drop("spans")


def _matches(kind: str, k: int, pattern: str, good: str) -> str:
    """Rows (doc_id, k, kind, a, z) of a pattern's matches: between them the text is cut, so their places follow from lengths."""
    return f"""{kind}_0 AS (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, regexp_split_to_array(t, '{pattern}') AS gaps FROM d),
{kind}_1 AS (SELECT doc_id, ms[i] AS m, list_sum(list_transform(gaps[1 : i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1 : i - 1], lambda x: length(x))), 0) AS a FROM {kind}_0, LATERAL (SELECT unnest(generate_series(1, len(ms))) AS i)),
{kind} AS (SELECT doc_id, {k} AS k, '{kind}' AS kind, CAST(a AS BIGINT) AS a, CAST(a + length(m) AS BIGINT) AS z FROM {kind}_1 WHERE {good})"""


_NUM = "regexp_replace(m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(string_split(reverse({_NUM}), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN CAST(c AS INT) WHEN CAST(c AS INT) > 4 THEN CAST(c AS INT) * 2 - 9 ELSE CAST(c AS INT) * 2 END)) % 10 = 0"
BASE_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
{_matches("email", 0, EMAIL.pattern.decode().replace("(", "(?:"), "true")},
{_matches("ip", 1, IP.pattern.decode().replace("(", "(?:"), "list_max(list_transform(string_split(m, '.'), lambda x: CAST(x AS HUGEINT))) <= 255")},
{_matches("card", 2, CARD.pattern.decode().replace("(", "(?:"), f"length({_NUM}) BETWEEN 14 AND 19 AND {_LUHN}")},
{_matches("phone", 3, r"[+][0-9][ ().0-9-]+[0-9]", f"length({_NUM}) BETWEEN 10 AND 15")},
s AS (SELECT * FROM email UNION ALL SELECT * FROM ip UNION ALL SELECT * FROM card UNION ALL SELECT * FROM phone)
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_email, count(*) FILTER (k = 1) AS n_ip, count(*) FILTER (k = 2) AS n_card, count(*) FILTER (k = 3) AS n_phone, sha256(coalesce(string_agg(kind || ':' || a || ':' || z, ',' ORDER BY a, k), '')) AS base_sha256
FROM d LEFT JOIN s USING (doc_id) GROUP BY d.doc_id
"""
