"""Benchmark decontamination with a distributed positional inverted index.

The index is partitioned by document, as search engines shard theirs: a segment covers the texts of one Arrow batch and holds, for
each term, the sorted list of its word positions. Segments are stored as Parquet in the shared folder. A search visits every segment
once, without any shuffle: for each phrase it takes the posting list of the segment's rarest term, shifts it by the term's offset in
the phrase, and intersects it with the shifted lists of the next rarest terms until it is empty or all terms are used.

The test items are read in blocks of bounded size and searched one block after another, so what is sent to the executors at a time
does not grow with the benchmark.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkit as tk
from .cluster import new_names, settle

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 8
SLOP = 4  # words by which a proximity match may be longer than its phrase
GAP = 1 << 10  # positions left free after each text; longer than any phrase
BLOCK_BYTES = 8 << 20
SEGMENT = "segment string, ids array<long>, n_words binary, base binary, terms binary, starts binary, positions binary"


def item_words(text: str | None) -> list[bytes]:
    """Words of a test item: A-Z lower-cased, then runs of digits, letters and non-ASCII characters; none of a null."""
    return WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(bytes(tk.LOWER)))


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Segments of the index of docs, one row each: all positions of every term of whole texts. Null texts have no words; null ids are kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hs, ps, ns, bases, at = [], [], [], [], 0
            for p in tk.pieces(batch, id_col, text_col):
                p.buf = tk.LOWER[p.buf]
                a, b, first = tk.words(p, tk.ALNUM_WORD)
                h = tk.span_hash(tk.prefix_hash(p.buf), a, b)
                n = np.diff(first)
                base = at + np.concatenate(([0], np.cumsum(n[:-1] + GAP))) if len(n) else np.zeros(0, np.int64)
                pos = np.arange(len(a)) + np.repeat(base - first[:-1], n)
                if len(n):
                    at = int(base[-1] + n[-1] + GAP)
                hs.append(h)
                ps.append(pos)
                ns.append(n)
                bases.append(base)
            if not hs:
                continue
            h, pos, n, base = (np.concatenate(x) for x in (hs, ps, ns, bases))
            order, begin = tk.group_ids(h)
            blob = lambda x, kind: pa.array([x.astype(kind).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.array([batch.column(id_col).to_pylist()], pa.list_(pa.int64())), blob(n, "i4"), blob(base, "i8"), blob(h[order[begin]] if len(begin) else h, "u8"), blob(np.append(begin, len(h)), "i8"), blob(pos[order], "i4" if at < 2**31 else "i8")],
                ["segment", "ids", "n_words", "base", "terms", "starts", "positions"],
            )

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, SEGMENT)


class Segment:
    """A stored segment, opened."""

    def __init__(self, row: dict) -> None:
        of = lambda k, kind: np.frombuffer(row[k], kind)
        self.ids, self.n_words, self.base, self.terms, self.starts = row["ids"], of("n_words", "i4"), of("base", "i8"), of("terms", "u8"), of("starts", "i8")
        n = int(self.starts[-1])
        self.positions = of("positions", "i4" if len(row["positions"]) == 4 * n else "i8")

    def lookup(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the posting list of each term begins and how long it is."""
        if not len(self.terms):
            z = np.zeros(len(terms), np.int64)
            return z, z
        j = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        found = self.terms[j] == terms
        return np.where(found, self.starts[j], 0), np.where(found, self.starts[j + 1] - self.starts[j], 0)

    def phrase(self, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
        """Positions at which the phrase occurs, given begin and length of the posting lists of its terms in order."""
        found = None
        for k in np.argsort(count, kind="stable"):
            at = self.positions[begin[k] : begin[k] + count[k]].astype(np.int64) - k
            if found is None:
                found = at
            else:
                j = np.minimum(np.searchsorted(at, found), len(at) - 1)
                found = found[at[j] == found]
            if not len(found):
                return found
        return found

    def near(self, begin: np.ndarray, count: np.ndarray, span: int) -> np.ndarray:
        """Starts of stretches of at most `span` words of one text that hold every one of the terms, in any order; each begins with one of them.

        Rarest term first: its places are dropped where a further term has none within reach, and of all lists only what is near the places left is read.
        """
        k = np.argsort(count, kind="stable")
        anchor = self.positions[begin[k[0]] : begin[k[0]] + count[k[0]]].astype(np.int64)
        lists = [self.positions[begin[i] : begin[i] + count[i]] for i in k]
        for at in lists[1:]:
            j = np.searchsorted(at, anchor - (span - 1))
            anchor = anchor[(j < len(at)) & (at[np.minimum(j, len(at) - 1)] < anchor + span)]
            if not len(anchor):
                return anchor
        close = []
        for at in lists:
            lo, hi = np.searchsorted(at, anchor - (span - 1)), np.searchsorted(at, anchor + span)
            n = hi - lo
            close.append(np.unique(at[np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(n.sum())].astype(np.int64)))
        s = np.unique(np.concatenate(close))
        for at in close:
            j = np.searchsorted(at, s)
            s = s[(j < len(at)) & (at[np.minimum(j, len(at) - 1)] < s + span)]
        return s


def _phrases(items: list[tuple[object, str | None]], window: int) -> tuple[np.ndarray, list[np.ndarray], list[list[object]]]:
    """Distinct term hashes; each distinct phrase as indexes into them; the items of each phrase."""
    by: dict[tuple[bytes, ...], dict[object, None]] = {}
    for item, text in items:
        w = item_words(text)
        if item is None or not w:
            continue
        for i in range(max(1, len(w) - window + 1)):
            by.setdefault(tuple(w[i : i + window]), {})[item] = None
    vocab = sorted({w for p in by for w in p})
    number = {w: i for i, w in enumerate(vocab)}
    return tk.hash_bytes(vocab), [np.array([number[w] for w in p]) for p in by], [list(x) for x in by.values()]


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[object, str | None]]]:
    """The test items in blocks of about block_bytes, each small enough to be sent to every executor; items of one text need not be in one block."""
    total = items.agg(F.sum(F.octet_length(F.col(text_col).cast("string")) + 64)).first()[0] or 0
    blocks = max(1, -(-int(total) // block_bytes))
    which = F.pmod(F.xxhash64(F.col(text_col).cast("string"), F.col(id_col)), F.lit(blocks))
    for b in range(blocks):
        part = items.where(which == b) if blocks > 1 else items
        yield [(r[0], r[1]) for r in part.select(F.col(id_col), F.col(text_col).cast("string")).collect()]


FOUND = "segment string, row long, doc_id long, n_words long, spans array<long>, items array<string>, near array<string>"


def search(segments: DataFrame, items: list[tuple[object, str | None]], window: int = WINDOW, slop: int | None = None, every: bool = True) -> DataFrame:
    """segment and row (which together name a text), doc_id, n_words, spans (hit word intervals: pairs of begin and end, flat), items (ids of items with an exact match), near (with a proximity match).

    Exact: phrases of `window` consecutive item words (an item of fewer words is one phrase). Proximity, only with a slop: all
    distinct words of such a phrase, in any order, within its length plus slop words; every exact match is one too. Items without
    words or with a null id match nothing. A row for each indexed text, or with every=False for those with a match.
    """
    terms, phrases, owners = _phrases(items, window)
    by_hash = np.argsort(terms, kind="stable")
    terms = terms[by_hash]
    rank = np.empty(len(by_hash), np.int64)
    rank[by_hash] = np.arange(len(by_hash))
    phrases = [rank[p] for p in phrases]
    width = max([1, *map(len, phrases)])
    grid = np.full((len(phrases), width), len(terms), np.int64)
    for i, p in enumerate(phrases):
        grid[i, : len(p)] = p

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                s = Segment(row)
                begin, count = s.lookup(terms)
                alive = np.flatnonzero((np.append(count, 1)[grid] > 0).all(axis=1)) if len(phrases) else []
                hits: dict[int, list[tuple[int, int]]] = {}
                found: dict[int, set] = {}
                close: dict[int, set] = {}
                for i in alive:
                    p, length = phrases[i], len(phrases[i])
                    at = s.phrase(begin[p], count[p])
                    if len(at):
                        doc = np.searchsorted(s.base, at, side="right") - 1
                        for d, x in zip(doc.tolist(), (at - s.base[doc]).tolist()):
                            hits.setdefault(d, []).append((x, x + length))
                            found.setdefault(d, set()).update(owners[i])
                    if slop is not None:
                        p = np.unique(p)
                        at = s.near(begin[p], count[p], length + slop)
                        for d in np.unique(np.searchsorted(s.base, at, side="right") - 1).tolist():
                            close.setdefault(d, set()).update(owners[i])
                n = len(s.ids)
                told = range(n) if every else sorted({*found, *close})
                names = lambda x: pa.array([sorted(map(str, x.get(d, ()))) for d in told], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["segment"]] * len(told), pa.string()), pa.array(told, pa.int64()), pa.array([s.ids[d] for d in told], pa.int64()), pa.array([int(s.n_words[d]) for d in told], pa.int64()), pa.array([[x for ab in _union(hits[d]) for x in ab] if d in hits else [] for d in told], pa.list_(pa.int64())), names(found), names(close)],
                    ["segment", "row", "doc_id", "n_words", "spans", "items", "near"],
                )

    return segments.mapInArrow(run, FOUND)


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _hit_words(spans: Column) -> Column:
    """Number of words in disjoint intervals given flat."""
    return F.aggregate(F.transform(spans, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, min_items: int = 2, slop: int | None = None) -> DataFrame:
    """One row per row of docs: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near (items with a proximity match; null without a slop) and spans of hit words.

    The index of docs does not depend on the benchmark. Its blocks are searched one after another and what each finds is written, so
    the driver and the executors hold one block at a time.

    Edge cases: null or empty texts have no words and no hits; null ids are kept; repeated rows give repeated results; an empty
    benchmark leaves everything clean; an item shorter than the window is one phrase; items repeated under one id count once; items
    without words or id count never; further columns of either table are ignored.
    """
    index = settle(build_index(docs, id_col, text_col), "postings")
    blocks = item_blocks(benchmark)
    first, rest = next(blocks), next(blocks, None)
    out = search(index, first, window, slop)
    if rest is not None:
        found = [settle(search(index, block, window, slop, every=False), "hits", free=False) for block in chain([first, rest], blocks)]
        hits = reduce(DataFrame.unionByName, found).groupBy("segment", "row").agg(
            F.collect_list("spans").alias("spans"), *(F.array_sort(F.array_distinct(F.flatten(F.collect_list(c)))).alias(c) for c in ("items", "near"))
        )
        texts = search(index, [], window).select("segment", "row", "doc_id", "n_words")
        out = texts.join(hits, ["segment", "row"], "left").withColumn("spans", _merge_spans(F.coalesce("spans", F.array().cast("array<array<bigint>>"))))
        out = out.withColumns({c: F.coalesce(c, F.array().cast("array<string>")) for c in ("items", "near")})
    return out.select(
        "doc_id", "n_words", _hit_words(F.col("spans")).alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") >= min_items).alias("contaminated"), (F.lit(None) if slop is None else F.size("near")).cast("long").alias("n_near"), "spans",
    )


@F.pandas_udf(T.ArrayType(T.LongType()))
def _merge_spans(lists: pd.Series) -> pd.Series:
    return lists.map(lambda x: [v for ab in _union([(int(s[i]), int(s[i + 1])) for s in x for i in range(0, len(s), 2)]) for v in ab])


def without_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_items: int = 1) -> DataFrame:
    """The rows of docs, all columns as they are, that hold passages of fewer than min_items items. Null and empty texts and, with an empty benchmark, all rows stay."""
    (key,) = new_names(docs, "__key")
    keyed = docs.withColumn(key, F.xxhash64(F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))))
    bad = settle(decontaminate(keyed, benchmark, key, text_col, min_items=min_items).where("contaminated").select(F.col("doc_id").alias(key)).distinct(), "contaminated", free=False)
    return keyed.join(bad, key, "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every benchmark item, by exact phrases of 8 words, and n_near: items of which the 8 words of a phrase stand within 12."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontaminate(docs, bench, slop=SLOP).drop("spans")


_W = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
OP1_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_W}') AS ws FROM benchmark WHERE item_id IS NOT NULL),
iw AS (SELECT DISTINCT item_id, array_to_string(ws[k : k + 7], ' ') AS win, least(len(ws), 8) AS n
       FROM i, LATERAL (SELECT unnest(generate_series(1, greatest(1, len(ws) - 7))) AS k) WHERE len(ws) > 0),
dw AS (SELECT doc_id, k, n, array_to_string(ws[k : k + n - 1], ' ') AS win
       FROM w, (SELECT DISTINCT n FROM iw) AS lens, LATERAL (SELECT unnest(generate_series(1, len(ws) - n + 1)) AS k) WHERE len(ws) >= n),
hit AS (SELECT doc_id, k, dw.n, item_id FROM dw JOIN iw ON dw.win = iw.win AND dw.n = iw.n),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(k, k + n - 1)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM hit)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id),
ww AS (SELECT DISTINCT win, n, unnest(string_split(win, ' ')) AS x FROM iw),
occ AS (SELECT doc_id, k, win, n, x, m FROM (SELECT doc_id, k, ws[k] AS x FROM w, LATERAL (SELECT unnest(generate_series(1, len(ws))) AS k)) JOIN ww USING (x) JOIN (SELECT win, count(*) AS m FROM ww GROUP BY win) USING (win)),
full_ AS (SELECT doc_id, win FROM occ GROUP BY doc_id, win, m HAVING count(DISTINCT x) = m),
clos AS (SELECT doc_id, win, m, count(DISTINCT x) OVER (PARTITION BY doc_id, win ORDER BY k RANGE BETWEEN CURRENT ROW AND n + 3 FOLLOWING) AS c FROM occ SEMI JOIN full_ USING (doc_id, win)),
nr AS (SELECT doc_id, count(DISTINCT item_id) AS n_near FROM (SELECT DISTINCT doc_id, win FROM clos WHERE c = m) JOIN iw USING (win) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near
FROM w LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN nr USING (doc_id)
"""
