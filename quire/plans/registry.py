"""The named queries of the engine and their DuckDB counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import fences, language, markdown
from ..functions.code import normal_form

from ..operators import batch, chapters, graft, pages, qa, render, scan, toc, vault
from . import chain
from . import substrates as sub

Query = Callable[[SparkSession, str], DataFrame]
_Q: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _Q[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_Q)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _q(text: str) -> str:
    return text.replace("'", "''")


def _n(c: Column) -> Column:
    return F.sum(F.when(c, 1).otherwise(0)).cast("long")


# -- Markdown

LEX = (
    sub.MD_DOCS
    + r""",
ls AS (SELECT conv_id, md, string_split(md, chr(10)) AS l FROM md_docs),
ln AS (SELECT conv_id, i - 1 AS i, l[i] AS line FROM ls, LATERAL (SELECT unnest(generate_series(1, len(l))) AS i)),
mk AS (SELECT conv_id, i, line, length(regexp_extract(line, '`{3,}')) AS n, regexp_full_match(line, '[ \t]{0,3}`{3,}[ \t]*') AS bare FROM ln WHERE regexp_full_match(line, '[ \t]{0,3}`{3,}[^`]*')),
en AS (SELECT a.conv_id, a.i AS s, min(b.i) AS e FROM mk a JOIN mk b ON a.conv_id = b.conv_id AND b.i > a.i AND b.bare AND b.n >= a.n GROUP BY a.conv_id, a.i),
nx AS (SELECT a.conv_id, a.s, a.e, min(b.s) AS nxt FROM en a LEFT JOIN en b ON a.conv_id = b.conv_id AND b.s > a.e GROUP BY a.conv_id, a.s, a.e),
fn AS (SELECT conv_id, s, e, nxt FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY s) AS r FROM nx) WHERE r = 1 UNION ALL SELECT nx.conv_id, nx.s, nx.e, nx.nxt FROM fn JOIN nx ON nx.conv_id = fn.conv_id AND nx.s = fn.nxt),
fb AS (SELECT fn.conv_id, fn.s, fn.e, regexp_extract(o.line, '^[ \t]{0,3}`{3,}(.*)$', 1) AS info, coalesce(string_agg(ln.line || chr(10), '' ORDER BY ln.i), '') AS body
       FROM fn JOIN ln o ON o.conv_id = fn.conv_id AND o.i = fn.s LEFT JOIN ln ON ln.conv_id = fn.conv_id AND ln.i > fn.s AND ln.i < fn.e GROUP BY ALL),
fl AS (SELECT *, lower(regexp_extract(trim(info), '^\S*')) AS lang FROM fb),
lc AS (SELECT ln.conv_id, ln.i, ln.line, f.lang, f.s IS NOT NULL AS in_code, f.s IS NOT NULL AND ln.i > f.s AND ln.i < f.e AS inside FROM ln LEFT JOIN fl f ON f.conv_id = ln.conv_id AND ln.i BETWEEN f.s AND f.e)"""
)


@query("fence_stats", f"WITH RECURSIVE {LEX} SELECT lang, count(*) AS n_blocks, CAST(sum(e - s - 1) AS BIGINT) AS n_lines FROM fl GROUP BY lang")
def fence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fences.fences(sub.md_docs(spark, sf_dir), "conv_id")
    return f.groupBy("lang").agg(F.count(F.lit(1)).alias("n_blocks"), F.sum(F.col("e") - F.col("s") - 1).cast("long").alias("n_lines"))


@query("fence_blocks", f"WITH RECURSIVE {LEX} SELECT conv_id, CAST(s AS BIGINT) AS s, CAST(e AS BIGINT) AS e, lang, info, md5(body) AS body_md5 FROM fl")
def fence_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fences.fences(sub.md_docs(spark, sf_dir), "conv_id")
    return f.select("conv_id", F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"), "lang", "info", F.md5("body").alias("body_md5"))


@query("illegal_codepoints", f"WITH {sub.MD_DOCS} SELECT conv_id, CAST(length(md) - length(regexp_replace(md, '[\\x{{FDD0}}-\\x{{FDEF}}\\x{{FFFE}}\\x{{FFFF}}]', '', 'g')) AS BIGINT) AS removed, CAST(len(regexp_extract_all(md, '[\\p{{L}}\\p{{N}}][\\x{{FDD0}}-\\x{{FDEF}}]+[\\p{{L}}\\p{{N}}]')) AS BIGINT) AS word_joins, md5(regexp_replace(md, '[\\x{{FDD0}}-\\x{{FDEF}}\\x{{FFFE}}\\x{{FFFF}}]', '', 'g')) AS md_md5 FROM md_docs")
def illegal_codepoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    md = F.col("md")
    return sub.md_docs(spark, sf_dir).select("conv_id", F.size(markdown.illegal_chars(md)).cast("long").alias("removed"), markdown.illegal_word_joins(md).alias("word_joins"), F.md5(markdown.strip_illegal(md)).alias("md_md5"))


_BULLET, _GLYPHS = markdown.BULLET, "".join(markdown.GLYPHS)
_IS_HEAD, _IS_ITEM = rf"regexp_matches(line, '^[ \t]{{0,3}}#{{1,6}}[ \t]*{_BULLET}[ \t]+')", rf"regexp_matches(line, '^[ \t]{{0,3}}\*?{_BULLET}[ \t]+')"
_MARKED = rf"CASE WHEN {_IS_HEAD} THEN regexp_replace(line, '^([ \t]{{0,3}}#{{1,6}})[ \t]*{_BULLET}[ \t]+', '\1 ') ELSE regexp_replace(line, '^([ \t]{{0,3}})\*?{_BULLET}[ \t]+', '\1- ') END"
_STRAY = rf"regexp_replace(regexp_replace(regexp_replace({_MARKED}, '(\s){_BULLET} ', '\1', 'g'), '(\s){_BULLET}', '\1', 'g'), '{_BULLET}(\s)', '\1', 'g')"
_FIX = f"translate({_STRAY}, '{_GLYPHS}', 'πΣ→')"
_N_BULLETS = lambda x: f"(length({x}) - length(replace({x}, '{_BULLET}', '')))"
_SYMBOLS = (
    LEX
    + rf""", cr AS (SELECT conv_id, contains(md, chr(13) || chr(10)) AS crlf FROM md_docs),
sy AS (SELECT lc.conv_id, any_value(crlf) AS crlf, string_agg(CASE WHEN in_code OR crlf THEN line ELSE {_FIX} END, chr(10) ORDER BY i) AS md,
  {", ".join(f"CAST(sum(CASE WHEN NOT in_code AND NOT crlf THEN {x} ELSE 0 END) AS BIGINT) AS {n}" for n, x in {"glyphs": f"length(line) - length(translate(line, '{_GLYPHS}', ''))", **{f"remap_{ord(g):04x}": f"length(line) - length(replace(line, '{g}', ''))" for g in markdown.GLYPHS}, "heading_markers": f"CASE WHEN {_IS_HEAD} THEN 1 ELSE 0 END", "list_markers": f"CASE WHEN {_IS_ITEM} THEN 1 ELSE 0 END", "stray_markers": f"{_N_BULLETS(_MARKED)} - {_N_BULLETS(_STRAY)}", "stray_unhandled": _N_BULLETS(_STRAY), "unknown": "0"}.items() if n != "unknown")},
  CAST(sum(CASE WHEN in_code AND NOT crlf THEN length(line) - length(translate(line, '{_GLYPHS}{_BULLET}', '')) ELSE 0 END) AS BIGINT) AS in_code,
  CAST(sum(CASE WHEN crlf THEN 0 ELSE length(regexp_replace(line, '[^\x{{E000}}-\x{{F8FF}}]|[{_GLYPHS}{_BULLET}]', '', 'g')) END) AS BIGINT) AS unknown
  FROM lc JOIN cr USING (conv_id) GROUP BY lc.conv_id)"""
)
_SYMBOL_NAMES = ["glyphs", *(f"remap_{ord(g):04x}" for g in markdown.GLYPHS), "heading_markers", "list_markers", "stray_markers", "stray_unhandled", "in_code", "unknown", "total_changes", "skipped_crlf"]


@query("symbol_remap", f"WITH RECURSIVE {_SYMBOLS} SELECT conv_id, md5(md) AS md_md5, * EXCLUDE (conv_id, md, crlf), glyphs + heading_markers + list_markers + stray_markers AS total_changes, crlf AS skipped_crlf FROM sy")
def symbol_remap(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sub.md_docs(spark, sf_dir)
    r = markdown.remap_report(F.col("md"))
    return d.select("conv_id", F.md5(markdown.remap(F.col("md"))).alias("md_md5"), *(r[n].alias(n) for n in _SYMBOL_NAMES))


@query("illegal_counts", rf"WITH {sub.MD_DOCS}, c AS (SELECT conv_id, unnest(regexp_extract_all(md, '[\x{{FDD0}}-\x{{FDEF}}\x{{FFFE}}\x{{FFFF}}]')) AS ch FROM md_docs) SELECT conv_id, format('{{:04x}}', unicode(ch)) AS code_point, count(*) AS n FROM c GROUP BY ALL")
def illegal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.md_docs(spark, sf_dir).select("conv_id", F.explode(markdown.illegal_counts(F.col("md"))).alias("code_point", "n"))


_CAP = r"'^(Example|Figure|Listing|Table)\s+((?:\d+\.)*\d+)\s+(\S.*)$'"


@query("caption_lift", rf"WITH RECURSIVE {LEX}, c AS (SELECT *, trim(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '\S'))[1]) AS first FROM fl WHERE lang <> 'mermaid') SELECT conv_id, CAST(s AS BIGINT) AS s, regexp_extract(first, {_CAP}, 1) || ' ' || regexp_extract(first, {_CAP}, 2) AS label FROM c WHERE regexp_matches(first, {_CAP})")
def caption_lift(spark: SparkSession, sf_dir: str) -> DataFrame:
    segs = F.filter(fences.segments(F.col("md")), lambda g: markdown._caption_of(g)[1])
    g = sub.md_docs(spark, sf_dir).select("conv_id", F.explode(segs).alias("g"))
    first = markdown._caption_of(F.col("g"))[0]
    return g.select("conv_id", F.col("g.s").cast("long").alias("s"), F.concat(F.regexp_extract(first, markdown.CAPTION, 1), F.lit(" "), F.regexp_extract(first, markdown.CAPTION, 2)).alias("label"))


_LIFT = rf"""WITH RECURSIVE {LEX},
cf AS (SELECT *, trim(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '\S'))[1]) AS first, string_split(body, chr(10)) AS bl FROM fl WHERE lang <> 'mermaid'),
cg AS (SELECT *, list_position(list_transform(bl, lambda x: trim(x)), first) AS ix, len(list_filter(bl, lambda x: regexp_matches(x, '\S'))) = 1 AS gone FROM cf WHERE regexp_matches(first, {_CAP})),
ch AS (SELECT *, ltrim(array_to_string(list_concat(bl[1 : ix - 1], bl[ix + 1 :]), chr(10)), chr(10)) AS rest FROM cg),
ci AS (SELECT ch.conv_id, ch.s, ch.e, regexp_extract(o.line, '^[ \t]*') || '**' || regexp_extract(first, {_CAP}, 1) || ' ' || regexp_extract(first, {_CAP}, 2) || '** ' || regexp_extract(first, {_CAP}, 3) || CASE WHEN gone THEN chr(10) ELSE chr(10) || chr(10) || o.line || chr(10) || rest || CASE WHEN rest LIKE '%' || chr(10) THEN '' ELSE chr(10) END || c.line END AS shown
  FROM ch JOIN ln o ON o.conv_id = ch.conv_id AND o.i = ch.s JOIN ln c ON c.conv_id = ch.conv_id AND c.i = ch.e)
SELECT ln.conv_id, md5(string_agg(CASE WHEN ci.s IS NULL THEN ln.line WHEN ln.i = ci.s THEN shown END, chr(10) ORDER BY ln.i)) AS md_md5 FROM ln LEFT JOIN ci ON ci.conv_id = ln.conv_id AND ln.i BETWEEN ci.s AND ci.e GROUP BY ln.conv_id"""


@query("caption_lifted_docs", _LIFT)
def caption_lifted_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.md_docs(spark, sf_dir).select("conv_id", F.md5(markdown.lift_captions(F.col("md"))).alias("md_md5"))


def _re2(pattern: str) -> str:
    """A pattern for DuckDB: its engine has no Unicode classes, and never takes another line end than the newline."""
    flags = re.match(r"\(\?([A-Za-z]+)\)", pattern)
    kept = "".join(c for c in flags[1] if c in "im") if flags else ""
    return _q((f"(?{kept})" if kept else "") + (pattern[flags.end() :] if flags else pattern))


def _guess_sql(b: str, first: str) -> str:
    """`language.guess_language` of a stripped body."""
    g = language
    any_ = lambda x, *ps: "(" + " OR ".join(f"regexp_matches({x}, '{_re2(p)}')" for p in ps) + ")"
    named = lambda p, bad: f"len(list_filter(regexp_extract_all({b}, '{_re2(p)}', 1), lambda n: {bad})) > 0"
    ts = f"({any_(b, g.TS)} OR {named(g.TS_TYPED, 'n NOT IN (' + ', '.join(map(repr, g.NO_NAME)) + ')')} OR ({any_(b, g.TS_WITH_JS)} AND {any_(b, g.JS)}))"
    make = f"({any_(b, g.MAKE)} OR {named(g.MAKE_TARGET, 'NOT ' + any_('n', g.NO_TARGET))})"
    prolog, url = f"starts_with({b}, '<?xml')", f"contains({b}, '://')"
    rules = [
        (any_(first, g._REQUEST, r"\AHTTP/[0-9]", g._HEADER), "http"), (any_(first, g.PROMPT), "bash"), (any_(b, g.ALGORITHM), "pseudocode"), (f"starts_with({b}, '<') AND NOT {prolog} AND {any_(b, g.HTML)}", "html"), (any_(b, g.CMAKE), "cmake"), (any_(b, g.RUST), "rust"), (any_(b, g.CPP), "cpp"), (any_(b, g.C_ANY), "c"),
        (make, "makefile"), (f"{any_(b, g.GO)} AND NOT {any_(b, g.HARDWARE)}", "go"), (ts, "typescript"), (any_(b, g.JS), "javascript"), (any_(b, g.RUBY), "ruby"), (any_(b, g.YAML), "yaml"), (any_(b, g.DOCKER), "dockerfile"), (f"{prolog} OR {any_(b, g.XML)} OR ({any_(b, chr(92) + 'A<[A-Za-z]')} AND {any_(b, g.CLOSED)})", "xml"),
        (f"{any_(b, chr(92) + 'A' + '[' + chr(92) + '[{]')} AND {any_(b, g.KEYED)}", "json"), (any_(b, g.JAVA), "java"), (any_(b, g.PYTHON), "python"), (any_(b, g.SQL), "sql"), (f"{any_(b, g.SHELL)} OR {any_(first, g.ASSIGNED)}", "bash"), (any_(b, g.SECTION), "ini"),
        (f"{any_(b, g.DOTTED)} AND NOT contains({first}, '://') AND NOT {any_(b, g.TOOL_LINE)}", "properties"), (f"len(regexp_extract_all({b}, '{_re2(g.PAIR)}')) >= 2 AND NOT {url} AND NOT {any_(first, g.CLOCK)}", "yaml"),
    ]
    return "CASE " + " ".join(f"WHEN {t} THEN '{n}'" for t, n in rules) + " ELSE 'text' END"


_MAP = lambda m: "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in m.items()) + "}"
_KEPT = "list_contains([" + ", ".join(f"'{t}'" for t in language.TRUSTED) + "], known)"


def _tagged(source: str, body: str) -> str:
    """dt: the rows of source (with lang and info) with may (be retagged), tag and why."""
    first = "coalesce(list_filter(string_split(sb, chr(10)), lambda x: regexp_matches(x, '\\S'))[1], '')"
    return rf"""d0 AS (SELECT *, regexp_replace({body}, '^\s+|\s+$', '', 'g') AS sb, lower(regexp_extract({body}, '#\s*file:\s*\S+\.([A-Za-z0-9]+)', 1)) AS ext, coalesce({_MAP(language.EXTENSIONS | language.ALIASES)}[lang], lang) AS known FROM {source}),
d1 AS (SELECT *, {first} AS first_line, {_MAP(language.EXTENSIONS)}[ext] AS named FROM d0),
dt AS (SELECT *, lang <> 'mermaid' AND sb <> '' AND NOT starts_with(trim(info), '{{') AS may, CASE WHEN named IS NOT NULL THEN named WHEN {_KEPT} THEN known ELSE {_guess_sql("sb", "first_line")} END AS tag, CASE WHEN named IS NOT NULL THEN 'ext' WHEN {_KEPT} THEN 'kept' ELSE 'kw' END AS why FROM d1)"""


@query("lang_retag", f"WITH RECURSIVE {LEX}, {_tagged('fl', 'body')} SELECT tag AS lang, why, count(*) AS n FROM dt WHERE may GROUP BY ALL")
def lang_retag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.decisions(sub.md_docs(spark, sf_dir))


@query("dash_fix", rf"WITH RECURSIVE {LEX} SELECT conv_id, md5(string_agg(CASE WHEN inside AND lang <> 'mermaid' THEN replace(regexp_replace(line, '(\s)[–—]([A-Za-z])', '\1--\2', 'g'), '−', '-') ELSE line END, chr(10) ORDER BY i)) AS md_md5 FROM lc GROUP BY conv_id")
def dash_fix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.md_docs(spark, sf_dir).select("conv_id", F.md5(markdown.fix_dashes(F.col("md"))).alias("md_md5"))


@query("unescape", rf"WITH RECURSIVE {LEX} SELECT conv_id, md5(string_agg(CASE WHEN inside AND lang <> 'mermaid' THEN regexp_replace(regexp_replace(line, '(^|[^\\])\\([!#$%&*@_`~])', '\1\2', 'g'), '(^|[^\\])\\([!#$%&*@_`~])', '\1\2', 'g') ELSE line END, chr(10) ORDER BY i)) AS md_md5 FROM lc GROUP BY conv_id")
def unescape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.md_docs(spark, sf_dir).select("conv_id", F.md5(markdown.unescape_code(F.col("md"))).alias("md_md5"))


def _changed(new: str) -> str:
    return f"WITH RECURSIVE {LEX}, x AS (SELECT conv_id, lang, line, {new} AS new FROM lc WHERE inside AND lang <> 'mermaid') SELECT conv_id, lang AS tag, count(*) AS n, md5(string_agg(trim(line) || '|' || trim(new), '' ORDER BY line)) AS lines_md5 FROM x WHERE line <> new GROUP BY conv_id, lang"


def _changes(spark: SparkSession, sf_dir: str, of) -> DataFrame:
    c = sub.md_docs(spark, sf_dir).select("conv_id", F.explode(of(F.col("md"))).alias("c")).select("conv_id", "c.*")
    return c.groupBy("conv_id", "tag").agg(F.count(F.lit(1)).alias("n"), F.md5(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("old", "new"))), lambda x: F.concat(x["old"], F.lit("|"), x["new"])), "")).alias("lines_md5"))


@query("dash_changes", _changed(r"replace(regexp_replace(line, '(\s)[–—]([A-Za-z])', '\1--\2', 'g'), '−', '-')"))
def dash_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir, markdown.dash_changes)


@query("unescape_changes", _changed(r"regexp_replace(regexp_replace(line, '(^|[^\\])\\([!#$%&*@_`~])', '\1\2', 'g'), '(^|[^\\])\\([!#$%&*@_`~])', '\1\2', 'g')"))
def unescape_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _changes(spark, sf_dir, markdown.unescape_changes)


_CNT = lambda s: f"(length(body) - length(replace(body, {s}, ''))) // length({s})"


_ISSUES = f"{_CNT('chr(92) || chr(110)')} + {_CNT(chr(39) + '&quot;' + chr(39))} + list_sum(list_transform(string_split(body, chr(10)), lambda x: (length(x) - length(replace(x, '\"', ''))) % 2)) + abs({_CNT(chr(39) + '[' + chr(39))} - {_CNT(chr(39) + ']' + chr(39))}) + abs({_CNT(chr(39) + '{' + chr(39))} - {_CNT(chr(39) + '}' + chr(39))})"


@query("mermaid_score", f"WITH RECURSIVE {LEX} SELECT conv_id, CAST(s AS BIGINT) AS s, CAST({_ISSUES} AS BIGINT) AS issues FROM fl WHERE lang = 'mermaid'")
def mermaid_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = sub.md_docs(spark, sf_dir).select("conv_id", F.explode(markdown.mermaid_blocks(F.col("md"))).alias("g"))
    return g.select("conv_id", F.col("g.s").cast("long").alias("s"), markdown.diagram_issues(F.col("g.body")).cast("long").alias("issues"))


_LINK = markdown._LINK
_BEGIN, _STOP = _re2(rf"(?s)\A([\w&;\s]*?{markdown._OPENER})(['\"])(.*)\z"), _re2(rf'(?s)\A(.*)"{markdown._CLOSER}(.*)\z')
_BEGIN, _STOP = "(?s)" + _BEGIN, "(?s)" + _STOP


def _label_sql(s: str) -> str:
    return rf"""trim(regexp_replace(regexp_replace(translate({s}, '"[]{{}}\', '''()()'), '(?:<br>\s*)+', '<br>', 'g'), '^\s*<br>|<br>\s*$', '', 'g'))"""


def _node_sql(x: str) -> str:
    head, quote, inside = (f"regexp_extract({x}, '{_BEGIN}', {k})" for k in (1, 2, 3))
    ends = f"({quote} = '\"' AND regexp_matches({inside}, '{_STOP}'))"
    label, rest = f"CASE WHEN {ends} THEN regexp_extract({inside}, '{_STOP}', 1) ELSE {inside} END", f"CASE WHEN {ends} THEN regexp_extract({inside}, '{_STOP}', 2) ELSE '' END"
    return f"CASE WHEN regexp_matches({x}, '{_BEGIN}') THEN {head} || '\"' || {_label_sql(label)} || '\"' || translate(right({head}, 1), '([{{', ')]}}') || {rest} ELSE {x} END"


def _repaired_sql(body: str) -> str:
    """`markdown.repaired` of a body."""
    plain = "replace(replace(l, '\\n', '<br>'), '&quot;', '''')"
    nodes, links = f"regexp_split_to_array({plain}, '{_LINK}')", f"regexp_extract_all({plain}, '{_LINK}')"
    joined = f"array_to_string(list_transform(list_zip({nodes}, {links}), lambda z: {_node_sql('z[1]')} || coalesce(z[2], '')), '')"
    return f"array_to_string(list_transform(string_split({body}, chr(10)), lambda l: regexp_replace({joined}, '({markdown._CLOSER})(?:<br>|\\s|{markdown._CLOSER})*$', '\\1')), chr(10))"


@query("mermaid_repair", f"WITH RECURSIVE {LEX}, r AS (SELECT conv_id, s, body, {_repaired_sql('body')} AS new FROM fl WHERE lang = 'mermaid'), n AS (SELECT conv_id, {_ISSUES} AS a, body <> new AS changed, new FROM r), m AS (SELECT conv_id, a, changed, {_ISSUES} AS b FROM (SELECT conv_id, a, changed, new AS body FROM n)) SELECT d.conv_id, CAST(coalesce(sum(a), 0) AS BIGINT) AS score_before, CAST(coalesce(sum(b), 0) AS BIGINT) AS score_after, coalesce(bool_or(changed), false) AS changed FROM md_docs d LEFT JOIN m USING (conv_id) GROUP BY d.conv_id")
def mermaid_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sub.md_docs(spark, sf_dir).select("conv_id", "md", markdown.repair_diagrams(F.col("md")).alias("new"))
    score = lambda c: F.aggregate(markdown.mermaid_blocks(F.col(c)), F.lit(0).cast("long"), lambda a, g: a + markdown.diagram_issues(g["body"]))
    return d.select("conv_id", score("md").alias("score_before"), score("new").alias("score_after"), (F.col("md") != F.col("new")).alias("changed"))


_TITLE = r"trim(CASE WHEN regexp_matches(line, '^# .+$') THEN regexp_extract(line, '^# (.+)$', 1) WHEN regexp_matches(line, '^## Appendix [A-Z]\..+$') THEN regexp_extract(line, '^## (Appendix [A-Z]\..+)$', 1) END)"


@query("chapter_boundaries", f"WITH RECURSIVE {LEX} SELECT conv_id, CAST(i AS BIGINT) AS line_no, {_TITLE} AS title FROM lc WHERE NOT in_code AND {_TITLE} IS NOT NULL")
def chapter_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chapters.boundaries(sub.md_docs(spark, sf_dir), "conv_id").withColumn("line_no", F.col("line_no").cast("long"))


_SLUG = r"CASE WHEN trim(substr(regexp_replace(trim(regexp_replace(lower(title), '[^\p{L}\p{N}_\s-]', '', 'g')), '[\s_-]+', '-', 'g'), 1, 60), '-') = '' THEN 'untitled' ELSE trim(substr(regexp_replace(trim(regexp_replace(lower(title), '[^\p{L}\p{N}_\s-]', '', 'g')), '[\s_-]+', '-', 'g'), 1, 60), '-') END"


@query(
    "chapter_split",
    rf"""WITH RECURSIVE {LEX}, t AS (SELECT *, CASE WHEN NOT in_code THEN {_TITLE} END AS title FROM lc),
c AS (SELECT *, count(title) OVER (PARTITION BY conv_id ORDER BY i) AS chapter, count(title) OVER (PARTITION BY conv_id) AS n FROM t),
g AS (SELECT conv_id, chapter, max(title) AS title, string_agg(CASE WHEN title IS NOT NULL THEN '# ' || title ELSE line END, chr(10) ORDER BY i) AS content FROM c WHERE n > 0 GROUP BY conv_id, chapter)
SELECT conv_id, CAST(chapter AS BIGINT) AS chapter, title, CASE WHEN chapter = 0 THEN '00-front-matter.md' ELSE lpad(CAST(chapter AS VARCHAR), CAST(greatest(2, length(CAST(chapter AS VARCHAR))) AS INTEGER), '0') || '-' || {_SLUG} || '.md' END AS file_name, md5(trim(content, chr(10)) || chr(10)) AS content_md5
FROM g WHERE chapter > 0 OR regexp_matches(content, '\S')""",
)
def chapter_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = chapters.split(sub.md_docs(spark, sf_dir), "conv_id")
    return c.select("conv_id", "chapter", "title", "file_name", F.md5("content").alias("content_md5"))


_JSON = "'\"' || array_to_string(list_transform(string_split({0}, ''), lambda c: CASE WHEN c = '\"' THEN '\\\"' WHEN c = '\\' THEN '\\\\' WHEN c = chr(9) THEN '\\t' WHEN c = chr(13) THEN '\\r' WHEN unicode(c) > 127 THEN format('\\u{{:04x}}', unicode(c)) ELSE c END), '') || '\"'"


@query(
    "chapter_files",
    rf"""WITH RECURSIVE {LEX}, t AS (SELECT *, CASE WHEN NOT in_code THEN {_TITLE} END AS title FROM lc),
c AS (SELECT *, count(title) OVER (PARTITION BY conv_id ORDER BY i) AS chapter, count(title) OVER (PARTITION BY conv_id) AS n FROM t),
g AS (SELECT conv_id, chapter, coalesce(max(title), 'Front matter') AS title, string_agg(CASE WHEN title IS NOT NULL THEN '# ' || title ELSE line END, chr(10) ORDER BY i) AS content FROM c WHERE n > 0 GROUP BY conv_id, chapter)
SELECT conv_id, CAST(chapter AS BIGINT) AS chapter, md5('---' || chr(10) || 'title: ' || {_JSON.format("title")} || chr(10) || 'book: "Talk é' || conv_id || '"' || chr(10) || 'chapter: ' || chapter || chr(10) || 'source: "a b/' || conv_id || '.pdf"' || chr(10) || 'tags: [book]' || chr(10) || '---' || chr(10) || chr(10) || trim(content, chr(10)) || chr(10)) AS content_md5
FROM g WHERE chapter > 0 OR regexp_matches(content, '\S')""".replace('"Talk é', '"Talk \\u00e9'),
)
def chapter_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sub.md_docs(spark, sf_dir).withColumn("book", F.concat(F.lit("Talk é"), F.col("conv_id").cast("string"))).withColumn("source", F.concat(F.lit("a b/"), F.col("conv_id").cast("string"), F.lit(".pdf")))
    return chapters.split(d, "conv_id", book_col="book", source_col="source").select("conv_id", "chapter", F.md5("content").alias("content_md5"))


_LEGAL = LEX.replace("string_agg(piece, '' ORDER BY turn) AS md", "regexp_replace(string_agg(piece, '' ORDER BY turn), '[\\x{FDD0}-\\x{FDEF}\\x{FFFE}\\x{FFFF}]', '', 'g') AS md")
_CODE_LINE = r"regexp_replace(regexp_replace(replace(regexp_replace(l, '(\s)[–—]([A-Za-z])', '\1--\2', 'g'), '−', '-'), '(^|[^\\])\\([!#$%&*@_`~])', '\1\2', 'g'), '(^|[^\\])\\([!#$%&*@_`~])', '\1\2', 'g')"
_CLEAN = rf"""WITH RECURSIVE {_LEGAL}, cr AS (SELECT conv_id, contains(md, chr(13) || chr(10)) AS crlf FROM md_docs),
k0 AS (SELECT fl.*, o.line AS opener, c.line AS closer, trim(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '\S'))[1]) AS first, string_split(body, chr(10)) AS bl FROM fl JOIN ln o ON o.conv_id = fl.conv_id AND o.i = fl.s JOIN ln c ON c.conv_id = fl.conv_id AND c.i = fl.e),
k1 AS (SELECT *, coalesce(lang <> 'mermaid' AND regexp_matches(first, {_CAP}), false) AS cap, list_position(list_transform(bl, lambda x: trim(x)), first) AS ix, len(list_filter(bl, lambda x: regexp_matches(x, '\S'))) = 1 AS gone FROM k0),
k2 AS (SELECT *, CASE WHEN cap THEN ltrim(array_to_string(list_concat(bl[1 : ix - 1], bl[ix + 1 :]), chr(10)), chr(10)) END AS rest FROM k1),
k3 AS (SELECT * EXCLUDE (body, first), CASE WHEN NOT cap THEN body WHEN rest LIKE '%' || chr(10) THEN rest ELSE rest || chr(10) END AS body,
  CASE WHEN cap THEN regexp_extract(opener, '^[ \t]*') || '**' || regexp_extract(first, {_CAP}, 1) || ' ' || regexp_extract(first, {_CAP}, 2) || '** ' || regexp_extract(first, {_CAP}, 3) END AS line FROM k2),
{_tagged("k3", "body")},
k4 AS (SELECT dt.conv_id, s, e, cap, gone, CASE WHEN crlf THEN line ELSE {_FIX} END AS caption, CASE WHEN may AND regexp_extract(trim(info), '^\S*') <> tag THEN regexp_extract(opener, '^[ \t]*`+') || tag || CASE WHEN regexp_replace(trim(info), '^\S*\s*', '') <> '' THEN ' ' || regexp_replace(trim(info), '^\S*\s*', '') ELSE '' END ELSE opener END AS opener, closer,
  CASE WHEN lang = 'mermaid' THEN {_repaired_sql("body")} ELSE array_to_string(list_transform(string_split(body, chr(10)), lambda l: {_CODE_LINE}), chr(10)) END AS body FROM dt JOIN cr USING (conv_id)),
k5 AS (SELECT conv_id, s, e, CASE WHEN cap THEN caption || chr(10) ELSE '' END || CASE WHEN cap AND gone THEN '' ELSE CASE WHEN cap THEN chr(10) ELSE '' END || opener || chr(10) || body || closer END AS shown FROM k4),
k6 AS (SELECT ln.conv_id, string_agg(CASE WHEN k5.s IS NOT NULL THEN CASE WHEN ln.i = k5.s THEN shown END WHEN crlf THEN ln.line ELSE {_FIX.replace("line", "ln.line")} END, chr(10) ORDER BY ln.i) AS md FROM ln JOIN cr USING (conv_id) LEFT JOIN k5 ON k5.conv_id = ln.conv_id AND ln.i BETWEEN k5.s AND k5.e GROUP BY ln.conv_id)
SELECT conv_id, md5(md) AS md_md5, CAST(length(md) AS BIGINT) AS n_chars FROM k6"""


@query("clean_chain", _CLEAN)
def clean_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sub.md_docs(spark, sf_dir)
    return chain.clean_table(d).select("conv_id", F.md5("md").alias("md_md5"), F.length("md").cast("long").alias("n_chars"))


_REPORT_SQL = rf"""WITH RECURSIVE {_SYMBOLS},
cp AS (SELECT conv_id, count(*) AS n FROM (SELECT conv_id, trim(list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '\S'))[1]) AS first FROM fl WHERE lang <> 'mermaid') WHERE regexp_matches(first, {_CAP}) GROUP BY conv_id),
bn AS (SELECT conv_id, count(*) AS n, sum(CASE WHEN lang = 'mermaid' THEN {_ISSUES} ELSE 0 END) AS issues FROM fl GROUP BY conv_id), bd AS (SELECT conv_id, count(*) AS n FROM lc WHERE NOT in_code AND {_TITLE} IS NOT NULL GROUP BY conv_id)
SELECT d.conv_id, CAST(length(d.md) - length(regexp_replace(d.md, '[\x{{FDD0}}-\x{{FDEF}}\x{{FFFE}}\x{{FFFF}}]', '', 'g')) AS BIGINT) AS illegal, glyphs, coalesce(cp.n, 0) AS captions, coalesce(bn.n, 0) AS blocks, CAST(coalesce(issues, 0) AS BIGINT) AS diagram_issues, coalesce(bd.n, 0) AS chapters
FROM md_docs d JOIN sy USING (conv_id) LEFT JOIN cp USING (conv_id) LEFT JOIN bn USING (conv_id) LEFT JOIN bd USING (conv_id)"""


@query("chain_report", _REPORT_SQL)
def chain_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain.report(sub.md_docs(spark, sf_dir), "conv_id")


@query("chain_full_report")
def chain_full_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = chain.full_report(sub.md_docs(spark, sf_dir), "conv_id")
    n = lambda c: F.size(c).cast("long").alias(f"n_{c}")
    return r.select("conv_id", F.to_json("illegal_counts").alias("illegal_counts"), "illegal_word_joins", F.col("symbols.total_changes").alias("symbols"), F.col("symbols_after_captions.total_changes").alias("symbols_after_captions"), n("captions"), n("retags"), n("dashes"), n("escapes"), "diagrams_changed", "score_before", "score_after", F.array_join("titles", "|").alias("titles"), F.array_join("files", "|").alias("files"))


# -- blocks

_MATCH = (
    sub.BLOCKS
    + """,
b1 AS (SELECT * FROM base WHERE type NOT IN ('footer', 'header', 'page_number')),
m1 AS (SELECT * FROM model WHERE type = 'table' OR (type = 'image' AND content LIKE '%mermaid%') OR (type = 'equation' AND coalesce(text, '') <> '') OR (type = 'chart' AND regexp_matches(content, '\\S')) OR (type = 'code' AND code_body <> '')),
pr AS (SELECT b.book, b.ord, b.type, m.ord AS m_ord, greatest(0, least(b.x1, m.x1) - greatest(b.x0, m.x0)) * greatest(0, least(b.y1, m.y1) - greatest(b.y0, m.y0)) AS inter, (b.x1 - b.x0) * (b.y1 - b.y0) AS ab, (m.x1 - m.x0) * (m.y1 - m.y0) AS am FROM b1 b JOIN m1 m ON b.book = m.book AND b.abs_page = m.abs_page AND b.type = m.type),
sc AS (SELECT *, CASE WHEN inter > 0 AND ab + am - inter <> 0 THEN inter / (ab + am - inter) ELSE 0 END AS iou, CASE WHEN inter > 0 AND least(ab, am) <> 0 THEN inter / least(ab, am) ELSE 0 END AS con FROM pr),
rk AS (SELECT *, row_number() OVER (PARTITION BY book, ord ORDER BY iou DESC, m_ord) AS ri, row_number() OVER (PARTITION BY book, ord ORDER BY con DESC, m_ord) AS rc FROM sc),
hi AS (SELECT * FROM rk WHERE ri = 1 AND iou > 0.3),
hc AS (SELECT * FROM rk WHERE type = 'code' AND rc = 1 AND con > 0.8 AND NOT EXISTS (SELECT 1 FROM hi WHERE hi.book = rk.book AND hi.ord = rk.ord)),
hm AS (SELECT book, ord, m_ord, iou, con FROM hi UNION ALL SELECT book, ord, m_ord, iou, con FROM hc),
mt AS (SELECT b.*, hm.m_ord, hm.iou, hm.con FROM b1 b LEFT JOIN hm ON b.book = hm.book AND b.ord = hm.ord)"""
)


@query("best_match", f"WITH {_MATCH} SELECT book, ord, type, m_ord, round(iou, 6) AS iou FROM mt")
def best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = graft.best_match(graft.without_noise(sub.blocks(spark, sf_dir)), sub.blocks(spark, sf_dir, 1))
    return m.select("book", "ord", "type", "m_ord", F.round("m_iou", 6).alias("iou"))


@query("containment_match", f"WITH {_MATCH} SELECT book, ord, m_ord, round(con, 6) AS containment FROM mt WHERE type = 'code' AND iou <= 0.3")
def containment_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = graft.best_match(graft.without_noise(sub.blocks(spark, sf_dir)), sub.blocks(spark, sf_dir, 1))
    return m.where("type = 'code' AND m_iou <= 0.3").select("book", "ord", "m_ord", F.round("m_containment", 6).alias("containment"))


_FORM = lambda x: rf"CASE WHEN regexp_matches({x}, '^[ \t]*`{{3,}}') OR regexp_matches({x}, '^\s*(?:Table|Figure|Listing)\s+\d') THEN '' ELSE regexp_replace(regexp_replace(replace({x}, chr(92), ''), '[A-Za-z0-9+/=_-]{{30,}}', '§KEY§', 'g'), '\s+', '', 'g') END"
_NOISE = "(type = 'image' AND cap = '' AND (x1 - x0) * (y1 - y0) < 2500)"


@query(
    "merge_counters",
    rf"""WITH {_MATCH}, j AS (SELECT mt.*, {_NOISE.replace("type", "mt.type").replace("cap", "mt.cap").replace("x1", "mt.x1").replace("x0", "mt.x0").replace("y1", "mt.y1").replace("y0", "mt.y0")} AS noise, {_FORM("mt.code_body")} = {_FORM("m.code_body")} AS same FROM mt LEFT JOIN model m ON m.book = mt.book AND m.ord = mt.m_ord)
SELECT book, {", ".join(f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, c in {
        "table_swapped": "type = 'table' AND m_ord IS NOT NULL", "table_kept": "type = 'table' AND m_ord IS NULL", "mermaid_attached": "type = 'image' AND NOT noise AND m_ord IS NOT NULL", "images": "type = 'image' AND NOT noise", "eq_swapped": "type = 'equation' AND m_ord IS NOT NULL",
        "eq_kept": "type = 'equation' AND m_ord IS NULL", "chart_enriched": "type = 'chart' AND m_ord IS NOT NULL", "charts": "type = 'chart'", "noise_dropped": "noise", "code_verified": "type = 'code' AND m_ord IS NOT NULL AND same", "code_flagged": "type = 'code' AND m_ord IS NOT NULL AND NOT same", "code_pipeline_only": "type = 'code' AND m_ord IS NULL"}.items())} FROM j GROUP BY book""",
)
def merge_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = graft.counters(graft.merge(sub.blocks(spark, sf_dir), sub.blocks(spark, sf_dir, 1)))
    return c.select("book", *(x for x in graft.COUNTERS if x != "code_indent_flagged"))


@query("code_reconcile")
def code_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = graft.merge(sub.blocks(spark, sf_dir), sub.blocks(spark, sf_dir, 1))
    return m.where("type = 'code'").groupBy("book", "code_path").agg(F.count(F.lit(1)).alias("n"), _n(F.col("reindented")).alias("n_reindented"), _n(F.col("indent_flag")).alias("n_indent"), F.max(F.length(normal_form(F.col("code_body")))).cast("long").alias("longest_form"))


_MERGED = rf"""WITH {_MATCH}, j AS (SELECT mt.*, m.text AS m_text, m.code_body AS m_code, m.table_body AS m_table, m.content AS m_content, m.sub_type AS m_sub, mt.m_ord IS NOT NULL AS hit, {_FORM("mt.code_body")} = {_FORM("m.code_body")} AS same FROM mt LEFT JOIN model m ON m.book = mt.book AND m.ord = mt.m_ord)
SELECT book, ord, type, CASE type WHEN 'table' THEN CASE WHEN hit THEN 'table_swapped' ELSE 'table_kept' END WHEN 'equation' THEN CASE WHEN hit THEN 'eq_swapped' ELSE 'eq_kept' END WHEN 'chart' THEN CASE WHEN hit THEN 'chart_enriched' ELSE 'charts' END
  WHEN 'image' THEN CASE WHEN hit THEN 'mermaid_attached' ELSE 'images' END WHEN 'code' THEN CASE WHEN NOT hit THEN 'code_pipeline_only' WHEN same THEN 'code_verified' ELSE 'code_flagged' END END AS event,
  md5(concat_ws('|', CASE WHEN hit AND type = 'equation' THEN m_text ELSE text END, CASE WHEN type <> 'code' THEN code_body WHEN NOT hit THEN regexp_replace(code_body, '\s+$', '') WHEN same THEN m_code END, CASE WHEN hit AND type = 'table' THEN m_table ELSE table_body END, CASE WHEN hit AND type IN ('chart', 'image') THEN m_content ELSE content END, CASE WHEN hit AND type = 'code' THEN m_sub ELSE sub_type END)) AS content_md5
FROM j WHERE NOT {_NOISE}"""


@query("merged_blocks", _MERGED)
def merged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = graft.merge(sub.blocks(spark, sf_dir), sub.blocks(spark, sf_dir, 1))
    code = F.when(~F.col("code_flag"), F.col("code_body"))  # the indentation of flagged code is Python's to settle; code_reconcile has it
    return m.where("kept").select("book", "ord", "type", "event", F.md5(F.concat_ws("|", "text", code, "table_body", "content", "sub_type")).alias("content_md5"))


@query("type_histogram", f"WITH {sub.BLOCKS} SELECT type, count(*) AS n FROM base GROUP BY type")
def type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.blocks(spark, sf_dir).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


_LINES_BY_SOURCE = "SELECT source AS book, CAST(doc_id AS INT) AS abs_page, line AS text FROM @lines"


@query("repeated_lines", rf"WITH {sub.BLOCKS}, p AS (SELECT source AS book, count(DISTINCT doc_id) AS npages FROM documents GROUP BY source), t AS (SELECT DISTINCT source AS book, doc_id, trim(line, ' ' || chr(9) || chr(13)) AS text FROM lines) SELECT t.book, text, count(*) AS n_pages FROM t JOIN p USING (book) WHERE length(text) BETWEEN 1 AND 199 GROUP BY t.book, text, npages HAVING count(*) >= greatest(3, floor(0.04::DOUBLE * npages))")
def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = sub.sql(spark, sub._LINES_SPARK, documents=sub.table(spark, sf_dir, "documents"))
    b = sub.sql(spark, _LINES_BY_SOURCE, lines=lines)
    n = sub.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("book")).agg(F.count_distinct("doc_id").alias("npages"))
    return pages.repeated_lines(b, n, share=0.04)


#: the blocks of a pass that skips every third page: its pages are moved on by one there
_SKIPS = "CASE WHEN abs_page % 3 = 1 THEN abs_page + 1 ELSE abs_page END"


@query("coverage_gaps", f"WITH {sub.BLOCKS}, t AS (SELECT doc_id AS book, CAST(floor(pos / 8) AS INT) AS page, string_agg(line, ' ' ORDER BY pos) AS text FROM lines GROUP BY ALL), s AS (SELECT book, {_SKIPS} AS page FROM base) SELECT book, page FROM t WHERE length(trim(text)) > 50 AND NOT EXISTS (SELECT 1 FROM s WHERE s.book = t.book AND s.page = t.page)")
def coverage_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = sub.blocks(spark, sf_dir)
    text = render.assemble(b.select("book", "ord", F.col("text").alias("md"), F.col("abs_page").alias("page")), ["book", "page"], " ").withColumnRenamed("md", "text")
    return pages.coverage_gaps(text, b.withColumn("abs_page", F.expr(_SKIPS)))


@query("covered_pages", f"WITH {sub.BLOCKS} SELECT book, count(DISTINCT abs_page) AS n_pages FROM base GROUP BY book")
def covered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.covered_pages(sub.blocks(spark, sf_dir))


@query("pages_with_content", f"WITH {sub.BLOCKS} SELECT book, count(DISTINCT coalesce({_SKIPS}, 0)) AS n_pages FROM base GROUP BY book")
def pages_with_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.pages_with_content(sub.blocks(spark, sf_dir).withColumn("abs_page", F.expr(_SKIPS)))


#: rich blocks spread over more pages, so that there are gaps
_SPREAD = "CAST(abs_page * 2 + ord % 8 AS INT)"
_RICH = f"rp AS (SELECT DISTINCT book, {_SPREAD} AS page FROM base WHERE type IN ('table', 'image', 'chart', 'equation', 'code')), rn AS (SELECT *, CASE WHEN page - lag(page) OVER (PARTITION BY book ORDER BY page) <= 2 THEN 0 ELSE 1 END AS new FROM rp), rr AS (SELECT book, page, sum(new) OVER (PARTITION BY book ORDER BY page) AS run FROM rn), runs AS (SELECT book, CAST(min(page) AS BIGINT) AS a, CAST(max(page) AS BIGINT) AS b FROM rr GROUP BY book, run)"


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = pages.group_runs(pages.rich_pages(sub.blocks(spark, sf_dir).withColumn("abs_page", F.expr(_SPREAD))), 1)
    return r.select("book", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))


@query("rich_runs", f"WITH {sub.BLOCKS}, {_RICH} SELECT * FROM runs")
def rich_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir)


@query("capped_runs", f"WITH {sub.BLOCKS}, {_RICH}, x AS (SELECT book, b, unnest(generate_series(a, b, 3)) AS a FROM runs) SELECT book, CAST(a AS BIGINT) AS a, CAST(least(a + 2, b) AS BIGINT) AS b FROM x")
def capped_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.cap_runs(_runs(spark, sf_dir), 3).select("book", F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))


@query("lines_dropped", rf"WITH {sub.BLOCKS}, p AS (SELECT source AS book, count(DISTINCT doc_id) AS npages FROM documents GROUP BY source), t AS (SELECT DISTINCT source AS book, doc_id, trim(line, ' ' || chr(9) || chr(13)) AS text FROM lines), r AS (SELECT t.book, text FROM t JOIN p USING (book) WHERE length(text) BETWEEN 1 AND 199 GROUP BY t.book, text, npages HAVING count(*) >= greatest(3, floor(0.04::DOUBLE * npages))) SELECT source AS book, count(*) AS n FROM lines WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.book = lines.source AND r.text = trim(line, ' ' || chr(9) || chr(13))) GROUP BY source")
def lines_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = sub.sql(spark, _LINES_BY_SOURCE, lines=sub.sql(spark, sub._LINES_SPARK, documents=sub.table(spark, sf_dir, "documents")))
    n = sub.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("book")).agg(F.count_distinct("doc_id").alias("npages"))
    return pages.drop_lines(b, pages.repeated_lines(b, n, share=0.04)).groupBy("book").agg(F.count(F.lit(1)).alias("n"))


# -- table of contents

_KEY = r"regexp_replace(regexp_replace(lower(trim({})), '^(?:part|chapter|appendix)\s+[clxvi\d]+\s*[.:-]?\s*', ''), '[^a-z0-9]+', '', 'g')"
_TOC = f"""tb AS ({sub.TOC_BLOCKS.replace("@", "")}), te AS (SELECT book, seq, title, page1 - 1 AS page FROM ({sub.TOC.replace("@", "")}) WHERE level = 1 AND page1 >= 1),
bk AS (SELECT book, ord, abs_page, {_KEY.format("text")} AS key FROM tb), ek AS (SELECT book, seq, page, {_KEY.format("title")} AS key FROM te),
cd AS (SELECT e.book, e.seq, b.ord FROM ek e JOIN bk b ON e.book = b.book AND e.key = b.key AND e.key <> '' AND b.abs_page BETWEEN e.page - 1 AND e.page + 2)"""


def _toc(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    p = sub.table(spark, sf_dir, "pages")
    return sub.sql(spark, sub.TOC_BLOCKS, pages=p), toc.first_level(sub.sql(spark, sub.TOC, pages=p))


@query("toc_match", f"WITH {_TOC} SELECT book, seq, min(ord) AS ord FROM cd GROUP BY book, seq")
def toc_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toc.match(*_toc(spark, sf_dir))


_APPLY = f"""WITH {_TOC}, tm AS (SELECT book, seq, min(ord) AS ord FROM cd GROUP BY book, seq), nm AS (SELECT book, count(*) AS n FROM tm GROUP BY book),
un AS (SELECT te.* FROM te JOIN ek USING (book, seq) WHERE key <> '' AND NOT EXISTS (SELECT 1 FROM tm WHERE tm.book = te.book AND tm.seq = te.seq)),
nw AS (SELECT un.book, (SELECT min(ord) FROM tb WHERE tb.book = un.book AND tb.abs_page >= un.page) AS pl, 0 AS k, -seq AS s, trim(title) AS text, CAST(1 AS BIGINT) AS text_level, 'toc' AS src FROM un WHERE EXISTS (SELECT 1 FROM tb WHERE tb.book = un.book AND tb.abs_page = un.page)),
kp AS (SELECT tb.book, tb.ord AS pl, 1 AS k, 0 AS s, coalesce(trim(te.title), tb.text) AS text, CAST(CASE WHEN tm.ord IS NOT NULL THEN 1 WHEN nm.n >= 3 AND text_level = 1 THEN 2 ELSE text_level END AS BIGINT) AS text_level, src FROM tb LEFT JOIN tm ON tm.book = tb.book AND tm.ord = tb.ord LEFT JOIN te ON te.book = tm.book AND te.seq = tm.seq LEFT JOIN nm ON nm.book = tb.book)
SELECT book, row_number() OVER (PARTITION BY book ORDER BY pl, k, s) - 1 AS ord, text, text_level, src FROM (SELECT * FROM nw UNION ALL SELECT * FROM kp)"""


@query("toc_apply", _APPLY)
def toc_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = toc.apply(*_toc(spark, sf_dir))
    return out.select("book", F.col("ord").cast("long").alias("ord"), "text", F.col("text_level").cast("long").alias("text_level"), "src")


# -- rendering and review

_FLAGS = "ord % 10 = 0 AS code_flag, ord % 15 = 0 AS indent_flag, ord % 20 = 0 AS reindented"


def _flagged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.blocks(spark, sf_dir).selectExpr("*", *_FLAGS.split(", "))


_HEAD = "CASE WHEN text_level > 0 THEN repeat('#', text_level) || ' ' ELSE '' END || text"
_LIST = "'- ' || replace(text, ' ', chr(10) || '- ')"
_CODE = "'```' || sub_type || chr(10) || code_body || chr(10) || '```'"


def _cap(lead: str, tail: str) -> str:
    return f"CASE WHEN cap <> '' THEN {lead} || cap || '{tail}' ELSE '' END"


_NL2 = "chr(10) || chr(10)"
_FULL = f"""CASE type WHEN 'text' THEN {_HEAD} WHEN 'list' THEN {_LIST} WHEN 'equation' THEN text WHEN 'table' THEN table_body || {_cap(_NL2 + " || '*'", "*")}
 WHEN 'chart' THEN '![](' || img_path || ')' || {_cap(_NL2 + " || '*'", "*")} || CASE WHEN content IS NOT NULL THEN {_NL2} || '<details><summary>chart data</summary>' || {_NL2} || content || {_NL2} || '</details>' ELSE '' END
 WHEN 'image' THEN '![](' || img_path || ')' || {_cap(_NL2 + " || '*'", "*")}
 WHEN 'code' THEN CASE WHEN ord % 10 = 0 THEN '{_q(render.NOTE_TOKENS)}' || CASE WHEN ord % 20 = 0 THEN 'indentation the model''s' ELSE 'as they stand' END || '. -->' || chr(10) WHEN ord % 15 = 0 THEN '{_q(render.NOTE_INDENT.strip())}' || chr(10) ELSE '' END || {_CODE} ELSE '' END"""
_BRIEF = f"""CASE type WHEN 'text' THEN {_HEAD} WHEN 'list' THEN {_LIST} WHEN 'equation' THEN text WHEN 'table' THEN table_body || {_cap("chr(10) || '*'", "*")} WHEN 'code' THEN {_CODE}
 WHEN 'chart' THEN '[CHART ' || img_path || ']' || {_cap("' — '", "")} || CASE WHEN content IS NOT NULL THEN chr(10) || '[+DATA]' || chr(10) || content ELSE '' END WHEN 'image' THEN '[IMAGE ' || img_path || ']' || {_cap("' — '", "")} ELSE '' END"""


@query("render_full", f"WITH {sub.BLOCKS} SELECT book, ord, md5({_FULL}) AS md_md5 FROM base")
def render_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _flagged_blocks(spark, sf_dir)
    return b.select("book", "ord", F.md5(render.full(b)).alias("md_md5"))


@query("render_qa", f"WITH {sub.BLOCKS} SELECT book, ord, md5({_BRIEF}) AS md_md5 FROM base")
def render_qa(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = sub.blocks(spark, sf_dir)
    return b.select("book", "ord", F.md5(render.brief(b)).alias("md_md5"))


@query("assemble_md", f"WITH {sub.BLOCKS} SELECT book, md5(string_agg({_FULL}, {_NL2} ORDER BY ord)) AS md_md5 FROM base GROUP BY book")
def assemble_md(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _flagged_blocks(spark, sf_dir)
    return render.assemble(b.withColumn("md", render.full(b)), ["book"]).select("book", F.md5("md").alias("md_md5"))


_REPORT = f"rp AS (SELECT book, CAST(count(*) FILTER (type = 'code') AS BIGINT) AS code_blocks, CAST(count(*) FILTER (type = 'code' AND (ord % 10 = 0 OR ord % 15 = 0)) AS BIGINT) AS flagged, CAST(count(*) FILTER (type = 'code' AND ord % 10 = 0) AS BIGINT) AS diverged, CAST(count(*) FILTER (type = 'code' AND ord % 10 <> 0 AND ord % 15 = 0) AS BIGINT) AS indent_suspect FROM base GROUP BY book)"


@query("flagged_report", f"WITH {sub.BLOCKS}, {_REPORT} SELECT * FROM rp")
def flagged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return qa.report(_flagged_blocks(spark, sf_dir))


@query("flagged_blocks", rf"WITH {sub.BLOCKS} SELECT book, CAST(row_number() OVER (PARTITION BY book ORDER BY abs_page, ord) AS BIGINT) AS rank, CAST(abs_page + 1 AS BIGINT) AS page, sub_type AS lang, CASE WHEN ord % 10 = 0 THEN 'diverged' ELSE 'indent' END AS flag, substr(trim(code_body), 1, 80) AS snippet FROM base WHERE type = 'code' AND (ord % 10 = 0 OR ord % 15 = 0)")
def flagged_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = qa.flagged(_flagged_blocks(spark, sf_dir))
    return f.withColumn("rank", F.col("rank").cast("long")).withColumn("page", F.col("page").cast("long"))


@query("flagged_rank", f"WITH {sub.BLOCKS}, {_REPORT} SELECT book, flagged, CAST(row_number() OVER (ORDER BY flagged DESC, book) AS BIGINT) AS rank FROM rp ORDER BY rank LIMIT 20")
def flagged_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = qa.rank_books(qa.report(_flagged_blocks(spark, sf_dir)).withColumn("input_pos", F.col("book")), 20)
    return top.select("book", "flagged", F.row_number().over(Window.orderBy(F.desc("flagged"), "book")).cast("long").alias("rank"))


#: every page is mapped, some twice; the later mapping counts
_MAPPING = "SELECT book, abs_page AS sample_idx, abs_page * 7 + 3 AS orig_page, 0 AS pos FROM base UNION ALL SELECT book, abs_page, abs_page * 7 + 1, 1 FROM base WHERE abs_page % 2 = 0"
_REVIEW = f"{sub.BLOCKS}, mp AS ({_MAPPING}), m AS (SELECT book, sample_idx, arg_max(orig_page, pos) AS orig_page FROM mp GROUP BY ALL), rv AS (SELECT m.book, CAST(sample_idx AS BIGINT) AS sample_idx, CAST(orig_page AS BIGINT) AS orig_page, string_agg({_BRIEF}, {_NL2} ORDER BY ord) AS md FROM m JOIN base b ON m.book = b.book AND b.abs_page = sample_idx GROUP BY ALL)"


def _mapping(b: DataFrame) -> DataFrame:
    page = F.col("abs_page")
    one, two = (b.where(c).select("book", page.alias("sample_idx"), (page * 7 + k).alias("orig_page"), F.lit(pos).alias("pos")) for c, k, pos in (("true", 3, 0), ("abs_page % 2 = 0", 1, 1)))
    return one.unionByName(two)


@query("review_pages", f"WITH {_REVIEW} SELECT book, sample_idx, orig_page, md5(md) AS md_md5 FROM rv")
def review_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = sub.blocks(spark, sf_dir)
    r = qa.review_pages(b, _mapping(b))
    return r.select("book", F.col("sample_idx").cast("long").alias("sample_idx"), F.col("orig_page").cast("long").alias("orig_page"), F.md5("md").alias("md_md5"))


@query("review_sheet", f"WITH {_REVIEW} SELECT book, md5(string_agg('=== page ' || (orig_page + 1) || ' (sample ' || sample_idx || ') ===' || chr(10) || md, {_NL2} ORDER BY sample_idx) || chr(10)) AS content_md5 FROM rv GROUP BY book")
def review_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = sub.blocks(spark, sf_dir)
    return qa.review_sheet(b, _mapping(b)).select("book", F.md5("content").alias("content_md5"))


@query("page_sample", "WITH b AS (SELECT source AS book, count(*) AS n FROM documents GROUP BY source), w AS (SELECT book, n, CAST(floor(n * 0.05::DOUBLE) AS INT) AS lo, CAST(floor(n * 0.95::DOUBLE) AS INT) AS hi FROM b), p AS (SELECT book, CAST(unnest(generate_series(CASE WHEN hi > lo THEN lo ELSE 0 END, CASE WHEN hi > lo THEN hi ELSE n END - 1)) AS INT) AS page FROM w) SELECT book, page FROM (SELECT *, row_number() OVER (PARTITION BY book ORDER BY md5(concat('42:', book, ':', page)), page) AS r FROM p) WHERE r <= 20")
def page_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    books = sub.table(spark, sf_dir, "documents").groupBy(F.col("source").alias("book")).agg(F.count(F.lit(1)).cast("int").alias("npages"))
    return qa.sample_pages(books)


# -- triage and batches

_SCAN = """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN concat('Copyright (c) ', 1990 + doc_id % 30, chr(10), text) WHEN doc_id % 4 = 1 THEN concat('In ', 1950 + doc_id % 70, ' and 2001', chr(10), text) ELSE text END AS text, concat('/in/', CASE WHEN doc_id % 2 = 0 THEN '9781234567890-' ELSE '' END, 'the_book-', doc_id, '.pdf') AS file FROM @documents"""


def _scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sub.sql(spark, _SCAN, documents=sub.table(spark, sf_dir, "documents"))
    return scan.scan(d.select("doc_id", "file", F.lit(1).alias("npages"), F.array("text").alias("texts"), F.lit(None).cast("string").alias("error"))).withColumn("doc_id", F.regexp_extract("file", r"-(\d+)\.pdf", 1).cast("long"))


_GOOD = r"length(x) BETWEEN 8 AND 90 AND NOT regexp_matches(x, '(?:19|20)[0-9]{2}') AND NOT contains(x, '©') AND NOT contains(lower(x), 'http') AND NOT regexp_matches(lower(x), '^(?:all rights|copyright|isbn|www\.)') AND length(regexp_replace(x, '\P{L}', '', 'g')) / greatest(length(x), 1) > 0.6"


@query("title_guess", rf"WITH s AS ({_SCAN.replace('@', '')}), t AS (SELECT doc_id, file, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: {_GOOD})[1] AS found FROM s) SELECT doc_id, coalesce(found, 'the book ' || doc_id) AS title, CASE WHEN found IS NULL THEN 'filename-fallback' ELSE 'text' END AS title_conf FROM t")
def title_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir).select("doc_id", "title", "title_conf")


@query("year_guess", rf"WITH s AS ({_SCAN.replace('@', '')}), t AS (SELECT doc_id, list_max(list_transform(regexp_extract_all(coalesce(text, ''), '(?i)copyright\s*(?:©|\(c\))?\s*(?:19|20)[0-9]{{2}}'), lambda x: CAST(right(x, 4) AS BIGINT))) AS told, list_max(list_transform(regexp_extract_all(coalesce(text, ''), '(?:19|20)[0-9]{{2}}'), lambda x: CAST(x AS BIGINT))) AS loose FROM s) SELECT doc_id, coalesce(told, loose) AS year, CASE WHEN told IS NOT NULL THEN 'copyright-line' WHEN loose IS NOT NULL THEN 'loose-year' ELSE 'none-found' END AS year_conf FROM t")
def year_guess(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scan(spark, sf_dir).select("doc_id", F.col("year").cast("long").alias("year"), "year_conf")


_MAN = "SELECT CAST(o_orderkey AS STRING) AS slug, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'convert_failed' ELSE 'fetch_failed' END AS status, o_orderpriority AS error_class, o_custkey AS book, o_orderkey AS seq FROM @orders"


def _attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.sql(spark, _MAN, orders=sub.table(spark, sf_dir, "orders"))


@query("manifest_rollup", f"WITH m AS ({_MAN.replace('@', '')}) SELECT error_class, count(*) AS n FROM m WHERE status <> 'done' GROUP BY error_class")
def manifest_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.error_classes(_attempts(spark, sf_dir))


@query("manifest_to_do", f"WITH m AS ({_MAN.replace('@', '')}) SELECT CAST(o_orderkey AS VARCHAR) AS slug, o_orderkey AS pos FROM orders WHERE CAST(o_orderkey AS VARCHAR) NOT IN (SELECT slug FROM m WHERE status = 'done')")
def manifest_to_do(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = _attempts(spark, sf_dir)
    return batch.to_do(m.select("slug", F.col("seq").alias("pos")), m)


@query("failure_runs", f"WITH m AS ({_MAN.replace('@', '')}), a AS (SELECT book, seq, status = 'done' AS ok, sum(CASE WHEN status = 'done' THEN 1 ELSE 0 END) OVER (PARTITION BY book ORDER BY seq) AS since FROM m) SELECT book, seq, ok, CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) OVER (PARTITION BY book, since ORDER BY seq) AS BIGINT) AS streak FROM a")
def failure_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.failure_runs(_attempts(spark, sf_dir).select("book", "seq", (F.col("status") == "done").alias("ok")))


# -- a vault

_VAULT = """SELECT concat('wiki/', CASE WHEN doc_id % 5 = 0 THEN 'notes' ELSE concat('domains/', source) END, '/page', doc_id, '.md') AS path,
  concat('see [[page', doc_id + 1, ']] and [[page', doc_id * 2, '|that]]', chr(10), CASE doc_id % 3 WHEN 0 THEN '> [!warning] careful' WHEN 1 THEN '> [!GAP]- none' ELSE '> [!note] plain' END, chr(10), coalesce(text, '')) AS text,
  concat('src/f', doc_id % 7, '.py', CASE WHEN doc_id % 4 = 0 THEN '' ELSE concat(':', doc_id % 90) END) AS place, concat('[[page', doc_id, ']]') AS page, concat('claim ', doc_id % 50) AS claim, CASE doc_id % 5 WHEN 0 THEN 'minor' WHEN 1 THEN 'critical' WHEN 2 THEN 'info' WHEN 3 THEN 'odd' ELSE 'major' END AS severity, doc_id
FROM @documents WHERE doc_id IS NOT NULL"""
_V = f"WITH v AS ({_VAULT.replace('@', '')})"


def _vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sub.sql(spark, _VAULT, documents=sub.table(spark, sf_dir, "documents"))


@query("vault_domains", rf"{_V} SELECT regexp_extract(path, 'wiki/domains/([^/]+)/', 1) AS domain, count(*) AS n FROM v WHERE path LIKE 'wiki/domains/%' GROUP BY 1")
def vault_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault.domains(_vault(spark, sf_dir))


_VAULT_LINKS = r"SELECT DISTINCT path, trim(unnest(regexp_extract_all(text, '\[\[([^\]|#\n]+)[^\]\n]*\]\]', 1))) AS target FROM v"


@query("vault_links", f"{_V} {_VAULT_LINKS}")
def vault_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault.links(_vault(spark, sf_dir))


@query("vault_broken_links", f"{_V} SELECT * FROM ({_VAULT_LINKS}) WHERE target NOT IN (SELECT 'page' || doc_id FROM v)")
def vault_broken_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault.broken_links(_vault(spark, sf_dir))


@query("vault_callouts", rf"{_V}, l AS (SELECT path, string_split(text, chr(10)) AS ls FROM v), e AS (SELECT path, k - 1 AS line_no, ls[k] AS line FROM l, LATERAL (SELECT unnest(generate_series(1, len(ls))) AS k)) SELECT path, CAST(line_no AS BIGINT) AS line_no, lower(regexp_extract(line, '(?i)^>\s*\[!(bug|contradiction|gap|warning)\]', 1)) AS kind, regexp_extract(line, '(?i)^>\s*\[![a-z]+\][+-]?\s*(.*)$', 1) AS title FROM e WHERE regexp_matches(line, '(?i)^>\s*\[!(?:bug|contradiction|gap|warning)\]')")
def vault_callouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault.callouts(_vault(spark, sf_dir)).withColumn("line_no", F.col("line_no").cast("long"))


@query("vault_search", f"{_V}, s AS (SELECT path, {' + '.join(f'CASE WHEN contains(lower(text), {w!r}) THEN 1 ELSE 0 END + CASE WHEN contains(lower(regexp_extract(path, {chr(39)}([^/]*).md${chr(39)}, 1)), {w!r}) THEN 2 ELSE 0 END' for w in ('the', 'page1', 'claim'))} AS score FROM v) SELECT path, CAST(score AS INTEGER) AS score FROM s WHERE score > 0 ORDER BY score DESC, path LIMIT 50")
def vault_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault.search(_vault(spark, sf_dir), ["the", "page1", "claim"], 50)


@query("vault_findings", rf"{_V}, g AS (SELECT DISTINCT place, page, claim, severity FROM v WHERE regexp_matches(place, '^[^:\s]+:\d+$')) SELECT severity, place, page, claim, CAST(row_number() OVER (ORDER BY CASE severity WHEN 'critical' THEN 1 WHEN 'major' THEN 2 WHEN 'minor' THEN 3 WHEN 'info' THEN 4 ELSE 5 END, place, claim, page) AS INTEGER) AS rank FROM g")
def vault_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vault.findings(_vault(spark, sf_dir).select("severity", "place", "page", "claim"))
