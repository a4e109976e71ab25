"""Quality rules: text statistics, and decision lists learned from labelled statistics by sequential covering.

Statistics are computed in one pass over whole texts without a shuffle. A list is grown on a bounded sample of labelled rows
(`FIT_ROWS`): each rule is a conjunction of threshold tests, grown greedily by information gain on two thirds of the sample and
pruned from its end on the rest; rows it covers are removed and the next is grown. The list becomes one ordered Spark conditional
expression, so applying it stays inside whole-stage code generation.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textkit as tk
from .cluster import settle

FIT_ROWS = 20_000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_distinct", "n_upper", "n_digits", "n_ends", "n_exclaims", "n_lines"]
_SYMBOLS = tk.table(*[(ord(c), ord(c)) for c in "#*$%&|<>"])
_UPPER, _DIGIT, _ENDS = tk.table((0x41, 0x5A)), tk.table((0x30, 0x39)), tk.table((0x2C, 0x2C), (0x2E, 0x2E))
_EXCLAIM = tk.table((0x21, 0x21))


def piece_stats(p: tk.Piece) -> dict[str, np.ndarray]:
    """The counts of each text of a piece."""
    buf, docs = p.buf, len(p.start)
    word_byte = tk.NOT_SPACE[buf]
    a, b = tk.spans(word_byte)
    first = np.searchsorted(a, np.append(p.start, len(buf) + 1))
    n = np.diff(first)
    doc = np.repeat(np.arange(docs), n)
    pre = tk.prefix_hash(buf)
    h = tk.span_hash(pre, a, b)
    edges = np.append(p.start, len(buf))

    def count(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(mask), edges))

    salt = tk.mix(np.arange(docs, dtype=tk.U64) + tk.U64(1))
    out = {"n_words": n, "word_chars": count(word_byte & ((buf & 0xC0) != 0x80)), "n_symbols": count(_SYMBOLS[buf]), "n_upper": count(_UPPER[buf]), "n_digits": count(_DIGIT[buf]), "n_ends": count(_ENDS[buf]), "n_exclaims": count(_EXCLAIM[buf])}
    # lines: the separator after each text is a newline too
    stop = np.flatnonzero(buf == 10)
    begin = np.concatenate(([0], stop[:-1] + 1)) if len(stop) else stop
    full = np.searchsorted(a, begin) < np.searchsorted(a, stop)
    begin, stop = begin[full], stop[full]
    line_doc = p.doc_of(begin)
    lines = np.bincount(line_doc, minlength=docs)
    order, heads = tk.group_ids(tk.mix(tk.span_hash(pre, begin, stop) ^ salt[line_doc]))
    out |= {"n_lines": lines, "n_dup_lines": lines - np.bincount(line_doc[order[heads]], minlength=docs)}
    # windows of three words
    key = tk.mix(h ^ salt[doc])
    order, heads = tk.group_ids(key)
    out["n_distinct"] = np.bincount(doc[order[heads]], minlength=docs)
    w = tk.window_hash(key, 3)
    inside = doc[: len(w)] == doc[2:] if len(w) else np.zeros(0, bool)
    at = np.flatnonzero(inside)
    order, heads = tk.group_ids(w[at])
    size = np.diff(np.append(heads, len(order)))
    again = at[order[np.repeat(size > 1, size)]]
    hit = np.zeros(len(a) + 2, bool)
    for k in range(3):
        hit[again + k] = True
    out["n_repeat_words"] = tk.per_doc(first, hit[: len(a)])
    return out


def text_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts in `COUNTS` of every whole text, a row for each row of docs.

    Null and empty texts count 0 throughout; null ids and repeated rows are kept; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in tk.pieces(batch, id_col, text_col):
                s = piece_stats(p)
                yield pa.RecordBatch.from_arrays([p.ids, *(pa.array(s[c].astype(np.int64)) for c in COUNTS)], ["doc_id", *COUNTS])

    return docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias(text_col)).mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def _ratio(a: str, b: str) -> Column:
    return F.col(a) / F.greatest(F.col(b), F.lit(1))


def features() -> dict[str, Column]:
    """Scale-free statistics as expressions over the counts."""
    return {
        "chars_per_word": _ratio("word_chars", "n_words"), "symbols_per_word": _ratio("n_symbols", "n_words"), "dup_line_share": _ratio("n_dup_lines", "n_lines"), "repeat_share": _ratio("n_repeat_words", "n_words"), "distinct_share": _ratio("n_distinct", "n_words"),
        "upper_share": _ratio("n_upper", "word_chars"), "digit_share": _ratio("n_digits", "word_chars"), "ends_per_word": _ratio("n_ends", "n_words"), "exclaims_per_word": _ratio("n_exclaims", "n_words"), "words_per_line": _ratio("n_words", "n_lines"),
    }


@dataclass
class Rule:
    """A conjunction of (feature, True for at least or False for at most, threshold), with its precision on the pruning rows."""

    tests: list[tuple[str, bool, float]]
    precision: float
    covered: int

    def __str__(self) -> str:
        return " and ".join(f"{f} {'>=' if up else '<='} {t:.6g}" for f, up, t in self.tests)


def _covers(tests: list[tuple[str, bool, float]], x: dict[str, np.ndarray], n: int) -> np.ndarray:
    m = np.ones(n, bool)
    for f, up, t in tests:
        m &= x[f] >= t if up else x[f] <= t
    return m


def _grow(x: dict[str, np.ndarray], y: np.ndarray, cuts: int, longest: int) -> list[tuple[str, bool, float]]:
    tests: list[tuple[str, bool, float]] = []
    m = np.ones(len(y), bool)
    while len(tests) < longest and (~y[m]).any():
        p, n = int(y[m].sum()), int((~y[m]).sum())
        best, pick = 1e-9, None
        for f in sorted(x):
            values = x[f][m]
            good = y[m]
            for t in np.unique(np.quantile(values[good], np.linspace(0, 1, cuts))) if p else ():
                for up in (True, False):
                    c = values >= t if up else values <= t
                    p1, n1 = int(good[c].sum()), int((~good[c]).sum())
                    gain = p1 * (np.log2(p1 / (p1 + n1)) - np.log2(p / (p + n))) if p1 else 0.0
                    if gain > best:
                        best, pick = gain, (f, up, float(t))
        if pick is None:
            break
        tests.append(pick)
        m &= _covers([pick], x, len(y))
    return tests


def learn_list(x: dict[str, np.ndarray], y: np.ndarray, fold: np.ndarray, max_rules: int = 12, min_precision: float = 0.9, min_cover: int = 3, cuts: int = 24, longest: int = 4) -> list[Rule]:
    """Ordered rules for y (true: the class that the rules catch). fold: true for rows used for pruning. With no positive rows the list is empty."""
    left = np.ones(len(y), bool)
    rules: list[Rule] = []
    while len(rules) < max_rules:
        g, q = left & ~fold, left & fold
        if y[g].sum() < min_cover:
            break
        tests = _grow({k: v[g] for k, v in x.items()}, y[g], cuts, longest)
        best: tuple[float, int] | None = None
        for k in range(1, len(tests) + 1):
            c = _covers(tests[:k], {f: v[q] for f, v in x.items()}, int(q.sum()))
            p, n = int(y[q][c].sum()), int((~y[q][c]).sum())
            worth = (p - n) / (p + n) if p + n else -1.0
            if best is None or worth > best[0]:
                best = (worth, k)
        if best is None:
            break
        tests = tests[: best[1]]
        c = _covers(tests, {f: v[q] for f, v in x.items()}, int(q.sum()))
        p, n = int(y[q][c].sum()), int((~y[q][c]).sum())
        if p + n == 0:  # too rare for the pruning rows: judged on those it was grown on
            c = _covers(tests, {f: v[g] for f, v in x.items()}, int(g.sum()))
            p, n = int(y[g][c].sum()), int((~y[g][c]).sum())
        if p < min_cover or p / (p + n) < min_precision:
            break
        rules.append(Rule(tests, p / (p + n), p + n))
        left &= ~_covers(tests, x, len(y))
    return rules


def list_expression(rules: list[Rule], caught: Column, otherwise: Column) -> Column:
    """The ordered conditional: `caught` where a rule holds, else `otherwise`."""
    of, out = features(), None
    for r in rules:
        cond = None
        for f, up, t in r.tests:
            c = of[f] >= F.lit(t) if up else of[f] <= F.lit(t)
            cond = c if cond is None else cond & c
        out = F.when(cond, caught) if out is None else out.when(cond, caught)
    return otherwise if out is None else out.otherwise(otherwise)


def fit_rules(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> list[Rule]:
    """Rules for low quality from at most fit_rows labelled rows, those whose ids hash lowest.

    labels: doc_id, quality (0 or 1). A null label or id is no label; of several for one id the lowest counts.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    of = features()
    one = F.min(F.struct(*COUNTS))  # of several rows of an id the least
    texts = stats.where("n_words > 0").join(F.broadcast(some), "doc_id").groupBy("doc_id", "quality").agg(one.alias("c")).select("doc_id", "quality", "c.*")
    rows = texts.select("doc_id", "quality", (F.crc32(F.col("doc_id").cast("string")) % 3 == 0).alias("fold"), *(c.alias(k) for k, c in of.items())).toPandas().sort_values("doc_id")
    x = {k: rows[k].to_numpy(np.float64) for k in of}
    return learn_list(x, rows["quality"].to_numpy() == 0, rows["fold"].to_numpy(bool))


def base_failed(min_words: int = 50, max_repeat: int = 50) -> Column:
    """Fewer than min_words words, or over max_repeat % of them in repeated three-word windows."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 50, max_repeat: int = 50) -> DataFrame:
    """One row per row of docs: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    base_failed: fewer than min_words words, or over max_repeat % of them in repeated three-word windows. kept: neither that nor a
    learned rule. Null and empty texts fail the base; without labels no rule is learned; null ids and repeated rows are kept as rows.
    """
    stats = settle(text_stats(docs, id_col, text_col), "quality-stats")
    rules = fit_rules(stats, labels)
    failed = base_failed(min_words, max_repeat)
    return stats.select("doc_id", *COUNTS[:5], failed.alias("base_failed"), (~failed & list_expression(rules, F.lit(False), F.lit(True))).alias("kept"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with rules learned from labels.quality."""
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return judge(docs, labels)


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op3 that the learned rules have no part in."""
    return text_stats(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", *COUNTS[:5], base_failed().alias("base_failed"))


BASE_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (SELECT doc_id, k, ws[k] || ' ' || ws[k + 1] || ' ' || ws[k + 2] AS x FROM w, LATERAL (SELECT unnest(generate_series(1, len(ws) - 2)) AS k)),
r AS (SELECT doc_id, k FROM (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, x) AS n FROM g) WHERE n > 1),
h AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS p FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(h.n, 0) AS BIGINT) AS n_repeat_words,
  len(ws) < 50 OR 100 * coalesce(h.n, 0) > 50 * len(ws) AS base_failed
FROM w LEFT JOIN l USING (doc_id) LEFT JOIN h USING (doc_id)
"""
