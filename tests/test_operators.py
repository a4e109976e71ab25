"""Relational operators on small tables."""

import json
import random

import pytest
from pyspark.sql import functions as F

from quire.functions import code
from quire.functions.geometry import containment, iou
from quire.operators import batch, chapters, graft, pages, qa, render, scan, toc
from quire.plans import chain
from quire.sources import guards, readers

BLOCK = "book string, ord long, abs_page int, type string, sub_type string, bbox array<double>, text string, text_level int, code_body string, table_body string, content string, img_path string, image_caption array<string>, table_caption array<string>, chart_caption array<string>, list_items array<string>"
NAMES = [x.split(" ")[0] for x in BLOCK.split(", ")]


def blocks(spark, rows):
    return spark.createDataFrame([tuple(({"book": "b", "ord": i, "abs_page": 0} | r).get(n) for n in NAMES) for i, r in enumerate(rows)], BLOCK)


def cols(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[1] for r in df.select("i", fn(F.col("s"))).orderBy("i").collect()]


def test_boxes(spark):
    df = spark.createDataFrame([([0.0, 0.0, 2.0, 2.0], [1.0, 1.0, 3.0, 3.0]), ([0.0, 0.0, 1.0, 1.0], [1.0, 0.0, 2.0, 1.0]), (None, [0.0, 0.0, 1.0, 1.0]), ([0.0, 0.0, 4.0, 4.0], [1.0, 1.0, 2.0, 2.0])], "a array<double>, b array<double>")
    got = df.select(F.round(iou(F.col("a"), F.col("b")), 4), F.round(containment(F.col("a"), F.col("b")), 4)).collect()
    assert [tuple(r) for r in got] == [(0.1429, 0.25), (0.0, 0.0), (0.0, 0.0), (0.0625, 1.0)]


def test_code_forms(spark):
    assert cols(spark, code.strip_callouts, ["a ① B\nb C", "return b", None]) == ["a\nb", "return b", ""]
    assert cols(spark, code.strip_listing_numbers, ["1 a\n2 b\n3 c", "3 a\n2 b\n1 c", "1 2\nx\ny"]) == ["a\nb\nc", "3 a\n2 b\n1 c", "1 2\nx\ny"]
    a, b, c = cols(spark, code.normal_form, ["```py\n1 x = 1\n2 y\\_z\n3 q\n```", "x=1\ny_z\nq", "x=1\ny.z\nq"])
    assert a == b != c
    assert cols(spark, code.indent_suspect, ["def f():\nreturn 1", "def f():\n    return 1", "def f\n  puts 1 => 2", "plain", None]) == [True, False, False, False, False]


def test_indent_is_grafted():
    assert code.graft_indent("def f():\n    x_1\n", ["def f():", "x.1"]) == ("def f():\n    x.1", True)
    assert code.graft_indent("def f():\n    a = 1\n    return a", ["def f():", "a = 1", "b = 2", "return a"]) == ("def f():\n    a = 1\n    b = 2\n    return a", True)
    assert code.graft_indent("if (x) {", ["if (x) {", "}"]) == ("if (x) {\n}", False)
    assert code.base_lines("1 a\n2 \\$b\n3 c ①") == ["a", "$b", "c"]


def test_merge(spark):
    box = [0.0, 0.0, 100.0, 100.0]
    base = blocks(spark, [
        {"type": "table", "bbox": box, "table_body": "old"}, {"type": "code", "bbox": box, "code_body": "def f():\nreturn a_b"}, {"type": "image", "bbox": [0.0, 0.0, 10.0, 10.0]}, {"type": "footer", "text": "x"}, {"type": "text", "text": " DRM "},
        {"type": "code", "bbox": [0.0, 200.0, 10.0, 210.0], "code_body": "z ①"}, {"type": "code", "bbox": [0.0, 300.0, 100.0, 320.0], "code_body": "q=1"}, {"type": "equation", "bbox": box, "text": "E"}, {"type": "image", "bbox": box, "image_caption": ["c"]},
    ])
    model = blocks(spark, [
        {"type": "table", "bbox": box, "table_body": "new"}, {"type": "table", "bbox": box, "table_body": "later tie"}, {"type": "code", "bbox": box, "code_body": "def f():\n    return a.b"}, {"type": "code", "bbox": [0.0, 300.0, 20.0, 320.0], "code_body": "q = 1"},
        {"type": "equation", "bbox": box, "text": "$E$"}, {"type": "image", "bbox": box, "content": "mermaid x"},
    ])
    m = graft.merge(base, model, spark.createDataFrame([("b", "DRM")], "book string, text string"))
    r = {x["ord"]: x for x in m.collect()}
    assert r[0]["table_body"] == "new" and r[0]["m_ord"] == 0
    assert (r[1]["code_path"], r[1]["code_body"], r[1]["reindented"]) == ("flagged", "def f():\n    return a_b", True)
    assert not r[2]["kept"] and 3 not in r and not r[4]["kept"]
    assert (r[5]["code_path"], r[5]["code_body"]) == ("pipeline_only", "z")
    assert (r[6]["code_path"], r[6]["code_body"]) == ("verified", "q = 1")
    assert r[7]["text"] == "$E$" and r[8]["content"] == "mermaid x"
    c = graft.counters(m).first().asDict()
    assert c == {"book": "b", "table_swapped": 1, "table_kept": 0, "mermaid_attached": 1, "images": 1, "eq_swapped": 1, "eq_kept": 0, "chart_enriched": 0, "charts": 0, "noise_dropped": 2, "code_verified": 1, "code_flagged": 1, "code_pipeline_only": 1, "code_indent_flagged": 0}


def test_pages(spark):
    p = spark.createDataFrame([("b", x) for x in (1, 2, 3, 9, 10, 30)], "book string, page int")
    assert sorted((r["a"], r["b"]) for r in pages.group_runs(p, 3).collect()) == [(1, 3), (9, 10), (30, 30)]
    one = spark.createDataFrame([("b", 0, 100)], "book string, a int, b int")
    assert sorted((r["a"], r["b"]) for r in pages.cap_runs(one, 25).collect()) == [(0, 24), (25, 49), (50, 74), (75, 99), (100, 100)]
    b = spark.createDataFrame([("b", i, " line ") for i in range(3)] + [("b", 0, "once"), ("b", None, None)], "book string, abs_page int, text string")
    n = spark.createDataFrame([("b", 4)], "book string, npages int")
    assert [tuple(r) for r in pages.repeated_lines(b, n).collect()] == [("b", "line", 3)]
    assert pages.drop_lines(b, pages.repeated_lines(b, n)).count() == 2
    texts = spark.createDataFrame([("b", 0, "x" * 60), ("b", 7, "y" * 60), ("b", 8, "short")], "book string, page int, text string")
    assert [tuple(r) for r in pages.coverage_gaps(texts, b).collect()] == [("b", 7)]
    with pytest.raises(pages.CoverageError):
        pages.assert_covered(texts, b)
    s = spark.createDataFrame([("ab abc", ["ab", "abc"])], "md string, w array<string>")
    assert s.select(pages.scrub(F.col("md"), F.col("w"))).first()[0] == "   "
    a = spark.createDataFrame([("b", i, ok) for i, ok in enumerate([True, False, False, True, False])], "book string, seq int, ok boolean")
    assert [r["streak"] for r in pages.failure_runs(a).orderBy("seq").collect()] == [0, 1, 2, 0, 1]


def test_toc(spark):
    b = spark.createDataFrame(
        [("b", 0, "text", "One", None, 1, "base"), ("b", 1, "text", "Chapter 2: Two", 2, 5, "base"), ("b", 2, "text", "spurious", 1, 6, "base"), ("b", 3, "text", "THREE", None, 9, "base"), ("b", 4, "text", "body", None, 12, "base"), ("b", 5, "text", "One", None, 1, "base")],
        "book string, ord long, type string, text string, text_level int, abs_page int, src string",
    )
    e = spark.createDataFrame([("b", 0, "Chapter 1: One", 1), ("b", 1, "Two", 4), ("b", 2, "Three", 9), ("b", 3, "Lost A", 12), ("b", 4, "Lost B", 12), ("b", 5, "Nowhere", 40), ("b", 6, "One", 1)], "book string, seq long, title string, page int")
    got = [(r["text"], r["text_level"]) for r in toc.apply(b, e).orderBy("ord").collect()]
    assert got == [("Chapter 1: One", 1), ("Two", 1), ("spurious", 2), ("Three", 1), ("Lost B", 1), ("Lost A", 1), ("body", None), ("One", 1)]
    assert cols(spark, toc.title_key, ["Appendix C. Data", "Appendix A. Data", None]) == ["data", "appendixadata", ""]


def test_chapters_lose_nothing(spark):
    md = "intro\n\n# One\na\n```\n# not\n```\n## Appendix B. Étude/x\nz\n"
    d = spark.createDataFrame([(1, md), (2, "no heading"), (3, "")], "i int, md string")
    r = chapters.split(d, "i").orderBy("chapter").collect()
    assert [(x["chapter"], x["file_name"]) for x in r] == [(0, "00-front-matter.md"), (1, "01-one.md"), (2, "02-appendix-b-étudex.md")]
    assert r[1]["content"] == "# One\na\n```\n# not\n```\n" and r[2]["content"] == "# Appendix B. Étude/x\nz\n"


def test_chain_report_and_chain(spark):
    d = spark.createDataFrame([(1, "# T\n```\nListing 1 \uf070 cap\n```\n\0x\n```code\nx := \\$1 –dev\n```")], "i int, md string")
    assert chain.report(d, "i").first()["captions"] == 1
    assert chain.clean_table(d).first()["md"] == "# T\n**Listing 1** π cap\n\nx\n```go\nx := $1 --dev\n```"


def test_render_and_review(spark):
    b = blocks(spark, [
        {"type": "text", "text": "T", "text_level": 2}, {"type": "code", "code_body": "x", "sub_type": "py"}, {"type": "list", "list_items": ["a", "b"]}, {"type": "chart", "img_path": "i", "chart_caption": ["c", "d"], "content": "1"}, {"type": "table", "table_body": None}, {"type": "what"}, {"type": "code", "code_body": "```js\ny\n```"},
    ]).withColumn("code_flag", F.col("ord") == 1).withColumn("indent_flag", F.lit(False)).withColumn("reindented", F.lit(True))
    md = [r[0] for r in b.orderBy("ord").select(render.full(b)).collect()]
    assert md[0] == "## T" and md[1].endswith("-->\n```py\nx\n```") and md[2] == "- a\n- b" and md[3].startswith("![](i)\n\n*c d*\n\n<details>") and md[4:6] == ["", ""] and md[6] == "```js\ny\n```"
    assert [r[0] for r in b.orderBy("ord").select(render.brief(b)).collect()][3] == "[CHART i] — c d\n[+DATA]\n1"
    assert [tuple(r) for r in qa.report(b).collect()] == [("b", 2, 1, 1, 0)]
    assert [tuple(r) for r in qa.flagged(b).collect()] == [("b", 1, 1, "py", "diverged", "x")]
    m = spark.createDataFrame([("b", 0, 17), ("b", 3, 20)], "book string, sample_idx int, orig_page int")
    assert [(r["orig_page"], r["md"] == "") for r in qa.review_pages(b, m).orderBy("sample_idx").collect()] == [(17, False), (20, True)]
    n = spark.createDataFrame([("b", 100), ("c", 1), ("d", 0)], "book string, npages int")
    s = [tuple(r) for r in qa.sample_pages(n).collect()]
    assert s == [tuple(r) for r in qa.sample_pages(n).collect()] and len([x for x in s if x[0] == "b"]) == 20 and ("c", 0) in s and all(5 <= p < 95 for b_, p in s if b_ == "b")
    assert qa.sample_pages_compat(100) == sorted(random.Random(42).sample(range(5, 95), 20))


def test_scan(spark):
    d = spark.createDataFrame([("/x/9781234567890-My_Book-2.pdf", 3, ["1234\nCopyright © 2019, copyright 2021", "A Real Title Here"], None), ("y.pdf", 1, ["in 1999 or 2004"], None), ("z.pdf", None, None, "broken")], "file string, npages int, texts array<string>, error string")
    r = [(x["title"], x["title_conf"], x["year"], x["year_conf"], x["error"]) for x in scan.scan(d).collect()]
    assert r == [("A Real Title Here", "text", 2021, "copyright-line", None), ("y", "filename-fallback", 2004, "loose-year", None), (None, None, None, None, "broken")]


def test_batch(spark, tmp_path):
    b = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "pos int, slug string")
    m = spark.createDataFrame([("a", "done", None), ("b", "convert_failed", "OOM")], "slug string, status string, error_class string")
    assert [r["slug"] for r in batch.to_do(b, m).collect()] == ["b", "c"] and [r["slug"] for r in batch.to_do(b, m, at_most=1).collect()] == ["b"]
    assert [tuple(r) for r in batch.error_classes(m).collect()] == [("OOM", 1)]
    new = batch.update(m, spark.createDataFrame([("b", "done", None)], "slug string, status string, error_class string"))
    assert sorted((r["slug"], r["status"]) for r in new.collect()) == [("a", "done"), ("b", "done")]

    def work(s):
        if s != "ok":
            raise OSError(s)

    assert [r["status"] for r in batch.run(["ok", "x", "y", "z", "ok"], work)] == ["done"] + ["convert_failed"] * 3
    (tmp_path / "STOP").touch()
    assert batch.run(["ok"], work, str(tmp_path / "STOP")) == []


def test_sources(spark, tmp_path):
    raw = '{"zz": 1, "type": "text", "bbox": "[1, 2, 3, 4]", "text": null}'
    (tmp_path / "a_content_list.json").write_text(f'[{raw}, {{"type": "code", "bbox": [0,0,1,1], "page_idx": 2}}]')
    r = readers.read_content_lists(spark, f"file://{tmp_path}/*_content_list.json", 40).orderBy("ord").collect()
    assert r[0]["raw"] == json.dumps(json.loads(raw), separators=(", ", ": ")).replace('", ', '", ') or json.loads(r[0]["raw"]) == json.loads(raw)
    assert r[0]["bbox"] == [1.0, 2.0, 3.0, 4.0] and r[0]["keys"] == ["zz", "type", "bbox", "text"] and (r[1]["abs_page"], r[0]["abs_page"]) == (42, 40)
    (tmp_path / "books.toml").write_text('[[book]]\npdf="a.pdf"\nslug="a"\n')
    assert readers.read_books(spark, str(tmp_path / "books.toml")).collect()[0]["slug"] == "a"
    (tmp_path / "m.json").write_text('{"a": {"status": "done", "minutes": 1.5}}')
    assert readers.read_manifest(spark, f"file://{tmp_path}/m.json").first()["minutes"] == 1.5
    readers.write_named(spark.createDataFrame([("01-x.md", "é")], "file_name string, content string"), f"{tmp_path}/out")
    assert (tmp_path / "out/01-x.md").read_text() == "é"


def test_guards():
    with pytest.raises(guards.Transient):
        guards.classify(503)
    with pytest.raises(guards.Permanent):
        guards.classify(200, 7)
    for bad in ("../x", "/etc/x", "a/../../b", "C:/x"):
        with pytest.raises(guards.Permanent):
            guards.safe_member(bad)
    assert guards.redact("https://h/p?token=1#x") == "https://h/p" and guards.one_mode(a=1, b=None) == "a"
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise guards.Transient
        return "ok"

    assert guards.retry(flaky, sleep=lambda s: None) == "ok"


def test_stream(spark, tmp_path):
    from quire.streaming.ingest import ingest

    (tmp_path / "in").mkdir()
    for k in range(2):
        (tmp_path / f"in/{k}.md").write_text("a\uf0a1 b")
        q = ingest(spark, f"file://{tmp_path}/in", f"file://{tmp_path}/out", f"file://{tmp_path}/ck")
        q.awaitTermination(60)
    assert [r["md"] for r in spark.read.parquet(f"file://{tmp_path}/out").collect()] == ["a b", "a b"]


def test_strip_takes_all_white_space_and_looks_at_the_ends_only(spark):
    """The same as (?U)\\s for every character, without a pattern that is tried at each place of a line."""
    from quire.functions import text

    ends = {text.strip: r"(?U)\A\s+|\s+\z", text.lstrip: r"(?U)\A\s+", text.rstrip: r"(?U)\s+\z"}
    d = spark.range(0x10000).where("id NOT BETWEEN 55296 AND 57343").select(F.expr("decode(unhex(lpad(hex(id), 4, '0')), 'UTF-16BE')").alias("c")).select(F.explode(F.array(F.concat("c", F.lit(" x"), "c", F.lit("y\t"), "c"), F.col("c"), F.lit(""), F.lit(None))).alias("t"))
    for f, pattern in ends.items():
        assert d.where(~f(F.col("t")).eqNullSafe(F.regexp_replace("t", pattern, ""))).count() == 0
        assert "regexp" not in d.select(f(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()


def test_partners_are_found_by_one_window(spark):
    rng = random.Random(5)
    box = lambda: [float(x := rng.randrange(4)), float(y := rng.randrange(4)), float(x + rng.randrange(1, 6)), float(y + rng.randrange(1, 6))]
    a, b = ([{"ord": i, "type": rng.choice(["code", "table"]), "bbox": box(), "code_body": "x"} for i in range(40)] for _ in range(2))
    def size(p):
        return (p[2] - p[0]) * (p[3] - p[1])
    def both(p, q):
        return max(0, min(p[2], q[2]) - max(p[0], q[0])) * max(0, min(p[3], q[3]) - max(p[1], q[1]))
    want = {}
    for x in a:
        c = [(both(x["bbox"], y["bbox"]), size(x["bbox"]), size(y["bbox"]), y["ord"]) for y in b if y["type"] == x["type"]]
        u, v = (max(((f(*t[:3]), -t[3]) for t in c), default=(0, 0)) for f in (lambda i, p, q: i / (p + q - i), lambda i, p, q: i / min(p, q)))
        want[x["ord"]] = -u[1] if u[0] > 0.3 else -v[1] if x["type"] == "code" and v[0] > 0.8 else None
    got = graft.best_match(blocks(spark, a), blocks(spark, b))
    assert {r["ord"]: r["m_ord"] for r in got.collect()} == want and len({*want.values()}) > 5
    plan = graft.merge(blocks(spark, a), blocks(spark, b))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1
