"""Chain reports, front matter, review sheets, files, ports, settings, batches."""

import json
import textwrap

import pytest
from pyspark.sql import functions as F

from quire import cli, config
from quire.functions import code, markdown
from quire.operators import chapters, pages, qa, toc
from quire.plans import chain, substrates
from quire.sources import guards, passes, readers

SF = "/root/testdata/sf0.001"
DOC = "\uf0a1 one \uf0a1 two\uf0a1x\n\n# Title \"é\"\n\n```\nListing 1.2 A \uf070 sum\n```\n\n```code\nrun –dev \\\\$x\nx := 1\n```\n\n```mermaid\nA[\"a\\nb\"] --> B[\"c\n```\nbad\ufdd0\ufdd0\n## Appendix A. More\ntext"


def docs(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, md string")


def test_the_chain_in_one_pass_is_its_steps(spark):
    d = substrates.md_docs(spark, SF).unionByName(spark.createDataFrame([(-1, DOC), (-2, DOC.replace("\n", "\r\n", 1)), (-3, ""), (-4, "```\nFigure 1 \uf0e5\nx\n```")], "conv_id long, md string"))
    one = d
    for step in chain.STEPS:
        one = spark.createDataFrame([tuple(r) for r in one.select("conv_id", step(F.col("md"))).collect()], d.schema)
    assert sorted(map(tuple, chain.clean_table(d).collect())) == sorted(map(tuple, one.collect()))


def test_full_report(spark):
    r = chain.full_report(docs(spark, DOC, "no heading", ""), "id").orderBy("id").collect()
    a = r[0]
    assert a["illegal_counts"] == {"fdd0": 2} and a["illegal_word_joins"] == 0
    s = a["symbols"]
    assert (s["list_markers"], s["stray_markers"], s["stray_unhandled"], s["glyphs"], s["in_code"], s["total_changes"]) == (1, 1, 1, 0, 1, 2) and s["in_code_counts"] == {"f070": 1}
    assert a["captions"] == ["Listing 1.2"] and a["symbols_after_captions"]["remap_f070"] == 1
    assert [(x["old"], x["new"], x["why"]) for x in a["retags"]] == [("code", "go", "kw")] and a["retags"][0]["snippet"].startswith("run")
    assert [(x["tag"], x["new"]) for x in a["dashes"]] == [("go", "run --dev \\\\$x")] and a["escapes"] == []
    assert a["diagrams_changed"] == 1 and a["score_before"] > a["score_after"]
    assert a["titles"] == ['Title "é"', "Appendix A. More"] and a["files"] == ["00-front-matter.md", "01-title-é.md", "02-appendix-a-more.md"]
    assert r[1]["titles"] == r[1]["files"] == [] and r[2]["illegal_counts"] == {}


def test_front_matter(spark):
    d = docs(spark, "intro\n# A \"é\"\nx").withColumn("book", F.lit("B: #1")).withColumn("src", F.lit("a\\b.pdf"))
    c = {r["chapter"]: r["content"] for r in chapters.split(d, "id", book_col="book", source_col="src").collect()}
    assert c[1] == '---\ntitle: "A \\"\\u00e9\\""\nbook: "B: #1"\nchapter: 1\nsource: "a\\\\b.pdf"\ntags: [book]\n---\n\n# A "é"\nx\n'
    assert c[0].startswith('---\ntitle: "Front matter"\n') and c[0].endswith("\n\nintro\n")
    with pytest.raises(chapters.NoBoundaries, match="1"):
        chapters.assert_bounded(docs(spark, "# a", "b"), "id")
    chapters.assert_bounded(docs(spark, "# a"), "id")


def test_indentation():
    model = ["def f(x):", "    y = 1", "    return y"]
    assert code.graft_indent("\n".join(model), ["def f(x):", "y = 2", "return y"]) == ("def f(x):\n    y = 2\n    return y", True)
    assert code.graft_indent("\n".join(model), ["def f(x):", "y = 2", "z = 3", "return y"]) == ("def f(x):\n    y = 2\n    z = 3\n    return y", True)
    assert code.graft_indent("\n".join(model), ["for x {", "y"]) == ("for x {\ny", False)
    assert code.graft_indent("```py\nif a:\n\n    b\n```", ["if A:", "B"]) == ("if A:\n\n    B", True)
    assert code.graft_indent("", ["a", ""]) == ("a", False) and code.partners(["a", "b", "c"], ["a", "X", "Y", "c"]) == [0, 1, 3]
    assert not code.parses("a\0b") and not code.parses("def") and code.parses("")


def test_review(spark):
    b = spark.createDataFrame([("b", 0, 0, "text", "one"), ("b", 1, 2, "text", "three"), ("b", 2, None, "text", "zero")], "book string, ord int, abs_page int, type string, text string")
    for c in ("sub_type", "code_body", "table_body", "content", "img_path"):
        b = b.withColumn(c, F.lit(None).cast("string"))
    for c in ("image_caption", "table_caption", "chart_caption", "list_items"):
        b = b.withColumn(c, F.lit(None).cast("array<string>"))
    b = b.withColumn("text_level", F.lit(None).cast("int"))
    m = spark.createDataFrame([("b", 1, 40, 0), ("b", 0, 7, 0), ("b", 0, 5, 1)], "book string, sample_idx int, orig_page int, pos int")
    assert qa.review_sheet(b, m).first()["content"] == "=== page 6 (sample 0) ===\none\n\nzero\n\n=== page 41 (sample 1) ===\n\n"
    assert qa.pages_with_content(b).first()["n_pages"] == 2 and pages.covered_pages(b).first()["n_pages"] == 2
    books = spark.createDataFrame([("a", 100), ("b", 1), ("c", 0)], "book string, npages int")
    s = qa.sample_pages(books).groupBy("book").agg(F.count_distinct("page").alias("n"), F.min("page").alias("a"), F.max("page").alias("z")).orderBy("book").collect()
    assert [(r["book"], r["n"]) for r in s] == [("a", 20), ("b", 1)] and s[0]["a"] >= 5 and s[0]["z"] < 95


def test_heading_repair_keeps_columns_and_strips(spark):
    b = spark.createDataFrame([("b", 0, 0, "text", "x", None, "k"), ("b", 1, 3, "code", None, None, "l"), ("b", 2, 3, "text", "y", 1, "m")], "book string, ord int, abs_page int, type string, text string, text_level int, extra string").withColumn("src", F.lit("base"))
    e = spark.createDataFrame([("b", 0, "\u00a0New one\t", 3), ("b", 1, "Second", 3), ("b", 2, "No text there", 1)], "book string, seq int, title string, page int")
    r = toc.apply(b, e).orderBy("ord").collect()
    assert [(x["text"], x["text_level"], x["extra"]) for x in r] == [("x", None, "k"), ("Second", 1, None), ("New one", 1, None), (None, None, "l"), ("y", 1, "m")]


def test_files(spark, tmp_path):
    blocks = [{"type": "text", "text": "é", "vendor": {"z": 1}, "page_idx": 1}, {"type": "code", "code_body": "x", "sub_type": None}]
    for part, first in (("a", 0), ("b", 40)):
        at = tmp_path / "out" / f"pass_p{first}-{first + 39}" / "auto"
        at.mkdir(parents=True)
        (at / f"{part}_content_list.json").write_text(json.dumps(blocks))
        (at / f"{part}_content_list_v2.json").write_text("[]")
    r = readers.read_content_lists(spark, f"file://{tmp_path}/out/*/*/*.json", readers.segment_start())
    assert sorted(x["abs_page"] for x in r.collect()) == [0, 1, 40, 41] and all(x["imgdir"].endswith("/auto") for x in r.collect())
    assert readers.read_content_lists(spark, f"file://{tmp_path}/out/*/*/*.json", None, newest_only=True).count() == 2
    one = pages.union_passes([r.withColumn("book", F.lit("b"))]).withColumn("code_flag", F.col("type") == "code").withColumn("src", F.lit("base"))
    assert sorted(x["ord"] for x in one.collect()) == [0, 1, 2, 3]
    (told,) = readers.blocks_json(one).collect()
    back = json.loads(told["content"])
    assert told["content"].startswith('[\n {\n  "type": ') and {"z": 1} in [x.get("vendor") for x in back] and sum(x.get("_code_flag", False) for x in back) == 2
    (tmp_path / "b.blocks.json").write_text(told["content"])
    again = readers.read_blocks(spark, f"file://{tmp_path}/b.blocks.json")
    assert sorted(x["abs_page"] for x in again.collect()) == [0, 1, 40, 41]
    m = spark.createDataFrame([("s", "done", None, 1.5, None, None, None), ("t", "convert_failed", "d", 0.1, "é", "ValueError", None)], cli.MANIFEST)
    readers.write_manifest(m, str(tmp_path / "m.json"))
    assert sorted(map(tuple, readers.read_manifest(spark, f"file://{tmp_path}/m.json").select(*m.columns).collect())) == sorted(map(tuple, m.collect()))
    assert [x["size"] for x in readers.list_files(spark, f"file://{tmp_path}/m.json").collect()] == [(tmp_path / "m.json").stat().st_size]


def test_settings(tmp_path):
    (tmp_path / "u.toml").write_text("seed = 1\nn = 3\nbreaker = 9")
    (tmp_path / "p.toml").write_text("seed = 2")
    assert config.load(user=str(tmp_path / "u.toml"), project=str(tmp_path / "p.toml")) == config.Config(seed=2, breaker=9)
    assert config.load(user=str(tmp_path / "none.toml")) == config.Config()
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "none.toml"))


def test_passes(tmp_path, monkeypatch):
    ran = []

    class Fake:
        def run(self, pdf, first, last, out, timeout):
            ran.append((first, last))
            if (first, last) == (40, 79) and len(ran) < 3:
                raise TimeoutError

    with pytest.raises(TimeoutError):
        passes.run_chunks(Fake(), "a.pdf", [(0, 39), (40, 79)], str(tmp_path))
    assert len(passes.run_chunks(Fake(), "a.pdf", [(0, 39), (40, 79)], str(tmp_path))) == 2 and ran == [(0, 39), (40, 79), (40, 79)]
    states = iter(["pending", "running", "done"])
    sent, time = [], iter(range(100))
    s = passes.Service(lambda name: ("j", "https://up"), lambda to, data: sent.append((to, data)), lambda job: (next(states), "https://out?x=1"), lambda at: b"zip", sleep=lambda _: None, clock=lambda: next(time))
    assert passes.run_service(s, "a", b"pdf") == b"zip" and sent == [("https://up", b"pdf")] and s.log == ["j: pending", "j: running", "j: done"]
    s.state = lambda job: ("running", "")
    with pytest.raises(guards.Permanent, match="no end"):
        passes.run_service(s, "a", b"pdf", timeout=5)
    s.state = lambda job: ("failed", "why")
    with pytest.raises(guards.Permanent, match="why"):
        passes.run_service(s, "a", b"pdf")
    s.submit = lambda name: ("j", "http://up")
    with pytest.raises(guards.Permanent, match="https"):
        passes.run_service(s, "a", b"pdf")
    monkeypatch.setenv("QUIRE_TOKEN", "t")
    assert passes.token() == "t" and passes.token("g") == "g"
    monkeypatch.delenv("QUIRE_TOKEN")
    with pytest.raises(ValueError):
        passes.token(file=str(tmp_path / "none"))


def test_batch_command(spark, tmp_path):
    for slug in ("one", "two"):
        for side in ("base", "model"):
            at = tmp_path / "passes" / slug / side / "x" / "auto"
            at.mkdir(parents=True)
            (at / "x_content_list.json").write_text("{" if slug == "two" else json.dumps([{"type": "text", "text": "T", "text_level": 1, "page_idx": 0}]))
    (tmp_path / "books.toml").write_text(textwrap.dedent("""
        [[book]]
        pdf = "1.pdf"
        slug = "one"
        domain = "java"
        [[book]]
        pdf = "2.pdf"
        slug = "two"
    """))
    args = ["batch", str(tmp_path / "books.toml"), str(tmp_path / "m.json"), f"file://{tmp_path}/passes", str(tmp_path / "out"), "--vault", str(tmp_path / "vault")]
    assert cli.main(args) == 1
    m = json.loads((tmp_path / "m.json").read_text())
    assert m["one"]["status"] == "done" and m["two"]["status"] == "convert_failed" and m["two"]["error_class"]
    assert (tmp_path / "vault/java/one/one.md").read_text() == "# T" and json.loads((tmp_path / "out/one/one.blocks.json").read_text())[0]["text"] == "T"
    assert cli.main([*args, "--only", "one"]) == 0


def test_convert_stops_at_dropped_pages(spark, tmp_path):
    (tmp_path / "b.json").write_text(json.dumps([{"type": "text", "text": "T", "page_idx": 0}]))
    spark.createDataFrame([("k", 0, "T"), ("k", 1, "long enough " * 9)], "book string, page int, text string").write.parquet(str(tmp_path / "t"))
    args = ["merge", f"file://{tmp_path}/b.json", f"file://{tmp_path}/b.json", "k", str(tmp_path / "o")]
    assert cli.main([*args, "--texts", str(tmp_path / "t")]) == 1 and not (tmp_path / "o").exists()
    assert cli.main(args) == 0


def test_diagram_labels(spark):
    (r,) = docs(spark, "A{'x [y]' --> B[\"q \\\\ 'z'\"]} <br>").select(markdown.repaired(F.col("md"))).first()
    assert r == "A{\"x (y)'\"} --> B[\"q  'z'\"]"
