"""Fences and clean-up steps."""

import random

import pytest
from pyspark.sql import functions as F

from quire.functions import fences, language, markdown


def apply(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, md string")
    return [r[1] for r in df.select("i", fn(F.col("md"))).orderBy("i").collect()]


def lex(md):
    """An independent lexer: (first, last) line of each closed fence."""
    import re

    ls, out, i = md.split("\n"), [], 0
    while i < len(ls):
        m = re.fullmatch(r"[ \t]{0,3}(`{3,})([^`]*)", ls[i])
        j = None
        if m:
            j = next((k for k in range(i + 1, len(ls)) if (c := re.fullmatch(r"[ \t]{0,3}(`{3,})[ \t]*", ls[k])) and len(c[1]) >= len(m[1])), None)
        if j is None:
            i += 1
        else:
            out.append((i, j))
            i = j + 1
    return out


def test_lexer_against_a_second_one(spark):
    rng = random.Random(7)
    parts = ["```", "````", "```py", " ```", "    ```", "~~~", "text", "", "``", "```a`b", "``` ", "\t```c++"]
    docs = ["\n".join(rng.choice(parts) for _ in range(rng.randrange(0, 14))) for _ in range(400)] + [""]
    got = apply(spark, lambda m: fences.fence_spans(F.split(m, "\n", -1)), docs)
    assert [[(s["s"], s["e"]) for s in x] for x in got] == [lex(d) for d in docs]


def test_rewriting_nothing_gives_the_document_back(spark):
    docs = ["", "a\n\nb\n", "x\n```py\nbody\n```\n", "```\n```", " ````java {a}\nx\n```\n````\ntail\n\n", "```open\nnever closed"]
    assert apply(spark, lambda m: fences.transform_fences(m, fences.rebuild), docs) == docs
    assert apply(spark, lambda m: fences.transform_text(m, lambda t: t), docs) == docs


@pytest.mark.parametrize(
    "before, after",
    [
        ("\uf0a1 item", "- item"), ("## \uf0a1 head", "## head"), ("a \uf0a1 b", "a b"), ("a\uf0a1b", "a\uf0a1b"), ("a\uf0a1 b", "a b"), ("\uf070\uf0e5\uf0ae", "πΣ→"), ("*\uf0a1 star", "- star"),
        ("```\n\uf0a1 code \uf070\n```", "```\n\uf0a1 code \uf070\n```"), ("a\r\n\uf070", "a\r\n\uf070"), ("end \uf0a1", "end "), ("x\uf0a1", "x\uf0a1"), ("", ""),
    ],
)
def test_glyphs(spark, before, after):
    assert apply(spark, markdown.remap, [before]) == [after]


def test_illegal(spark):
    t = "a\0b \ufdd0c\U0001ffff"
    assert apply(spark, markdown.strip_illegal, [t, None]) == ["ab c", None]
    assert apply(spark, markdown.illegal_word_joins, [t]) == [1]


def test_captions(spark):
    docs = ["```\nListing 3.1 Title here\n```\nx", "```java\n\nListing 1 A\ncode()\n```", "```mermaid\nListing 1 A\n```", "```\ncode\nListing 1 A\n```", "  ```\nFigure 2 B\n  ```"]
    want = ["**Listing 3.1** Title here\n\nx", "**Listing 1** A\n\n```java\ncode()\n```", docs[2], docs[3], "  **Figure 2** B\n"]
    assert apply(spark, markdown.lift_captions, docs) == want


def test_dashes_and_escapes(spark):
    assert apply(spark, markdown.fix_dashes, ["run –dev\n```sh\nrun –dev a–b −1\n–x\n```"]) == ["run –dev\n```sh\nrun --dev a–b -1\n--x\n```"] or apply(spark, markdown.fix_dashes, ["```sh\nrun –dev a–b −1\n```"]) == ["```sh\nrun --dev a–b -1\n```"]
    assert apply(spark, markdown.unescape_code, ["\\$\n```\n\\$ \\\\$ \\n \\_\n```"]) == ["\\$\n```\n$ \\\\$ \\n _\n```"]


def test_diagrams(spark):
    bad = '```mermaid\nA["Load \\"Balancer"] --> B["x<br>"}\nC["open --> D\n```'
    (fixed,) = apply(spark, markdown.repair_diagrams, [bad])
    score = lambda t: apply(spark, lambda m: markdown.diagram_issues(m), [t])[0]
    assert score(fixed) < score(bad) and 'B["x"]' in fixed and "Load" in fixed
    assert apply(spark, markdown.repair_diagrams, [fixed]) == [fixed]


CASES = {
    "http": "GET /x HTTP/1.1", "bash": "$ ls", "pseudocode": "x ← 1", "html": "<div>a</div>", "cmake": "add_library(x y.cc)", "rust": "let mut a = 1;", "cpp": "std::string s;", "c": "#define X 1", "makefile": ".PHONY: all", "go": "x := 1", "typescript": "export type A = {",
    "javascript": "const a = 1;", "ruby": "puts 1", "yaml": "kind: Pod", "dockerfile": "FROM alpine", "xml": "<pom><x/></pom>", "json": '{"a": 1}', "java": "@Inject\nFoo foo;", "python": "def f(): pass", "sql": "select 1", "ini": "[main]", "properties": "a.b=c", "text": "just words",
}


def test_languages(spark):
    got = apply(spark, language.guess_language, list(CASES.values()))
    assert dict(zip(CASES, got)) == {k: k for k in CASES}


def test_guards(spark):
    cases = {"signal a : integer := 0;": "text", "a: 1\nb: 2": "yaml", "pip install x": "bash", "go build ./...": "bash", "function f(x)\n  return x": "pseudocode", "<?xml version='1.0'?><table></table>": "xml", "type: string, format: x": "text", "": "text"}
    assert dict(zip(cases, apply(spark, language.guess_language, list(cases)))) == cases


def test_retag(spark):
    docs = ["```Java\nx\n```", "```code\nx := 1\n```", "```\n# file: a.yml\nx\n```", "```java {hl=1}\ny\n```", "``` \n\n```", "```mermaid\nx := 1\n```"]
    assert apply(spark, language.retag, docs) == ["```java\nx\n```", "```go\nx := 1\n```", "```yaml\n# file: a.yml\nx\n```", "```java {hl=1}\ny\n```", docs[4], docs[5]]


def test_languages_as_in_sql_where_letters_have_accents(spark):
    """Each body as DuckDB decides it; `chan` in French prose is where they parted."""
    import duckdb

    from quire.plans import registry

    rng = random.Random(3)
    parts = ["chan ère", "éé leèchan de", "échan aique", "chan x", "kind: Pod", "fn größe(", "dèf x", "defé", " $ ls", "puts 1", "Ähm: x", "ß: 1", "a: 1", "select a", "ſelect 1", "x\u000b:= 1", "é.a=b", "GET /x", "# file: a.yml", "ünew Promise", "imports fromé"]
    bodies = [*parts, *("\n".join(rng.choices(parts, k=rng.randrange(2, 4))) for _ in range(150))]
    got = apply(spark, lambda b: F.concat_ws(" ", *language.detect(F.lit("code"), b)), bodies)
    c = duckdb.connect()
    c.execute("CREATE TABLE fl (i INT, body VARCHAR, lang VARCHAR, info VARCHAR)")
    c.executemany("INSERT INTO fl VALUES (?, ?, 'code', 'code')", list(enumerate(bodies)))
    want = c.execute(f"WITH {registry._tagged('fl', 'body')} SELECT tag || ' ' || why FROM dt ORDER BY i").fetchall()
    assert [(b, g) for b, g, (w,) in zip(bodies, got, want) if g != w] == [] and len(want) == len(bodies)


def test_chain_as_in_sql_where_letters_have_accents(spark, tmp_path):
    """`clean_chain` tags code by its content too."""
    import duckdb

    from quire.plans import registry

    texts = ["Éé chan ère", "leèchan de le", "en échan aiquech", "chan x"]
    rows = [(c, t, "assistant", texts[(c + t) % 4]) for c in range(40) for t in range(4)]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    got = sorted(map(tuple, registry.queries()["clean_chain"](spark, str(tmp_path)).collect()))
    c = duckdb.connect()
    c.execute(f"CREATE TABLE conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert got == sorted(c.execute(registry.oracle_sql()["clean_chain"]).fetchall()) and len(got) == 40
