"""Vault queries and the command line."""

import json

import pytest

from quire import cli
from quire.operators import graft, vault


def test_vault(spark):
    p = spark.createDataFrame([("v/wiki/domains/java/concepts/Streams.md", "See [[Lambdas|x]] and [[Streams#a]].\n> [!warning] Old\n> [!note] no"), ("v/wiki/domains/java/Lambdas.md", "lambda [[Gone]]"), ("v/hot.md", "streams")], "path string, text string")
    assert [tuple(r) for r in vault.domains(p).collect()] == [("java", 2)]
    assert [r["target"] for r in vault.broken_links(p).collect()] == ["Gone"]
    assert [(r["line_no"], r["kind"], r["title"]) for r in vault.callouts(p).collect()] == [(1, "warning", "Old")]
    assert [(r["path"][-10:], r["score"]) for r in vault.search(p, ["streams"]).collect()] == [("Streams.md", 3), ("v/hot.md", 1)]
    s = spark.createDataFrame([("uses streams", "java"), ("uses go", "go")], "signal string, domain string")
    assert [r["signal"] for r in vault.coverage(s, p).collect()] == ["uses streams"]
    f = spark.createDataFrame([("minor", "a.py:1", "[[P]]", "x"), ("critical", "b.py:2", "[[P]]", "y"), ("critical", "b.py:2", "[[P]]", "y"), ("major", "b.py", "[[P]]", "z"), ("major", "c.py:3", "P", "z")], "severity string, place string, page string, claim string")
    assert [(r["rank"], r["claim"]) for r in vault.findings(f).orderBy("rank").collect()] == [(1, "y"), (2, "x")]


def test_images(spark):
    b = spark.createDataFrame([(0, "d", "x/a.png"), (1, "d", "b.png"), (2, "d", None)], "ord int, imgdir string, img_path string")
    e = spark.createDataFrame([("d/x/a.png",)], "path string")
    assert [r["img_path"] for r in graft.with_images(b, e).orderBy("ord").collect()] == ["images/a.png", "b.png", None]


def test_commands(spark, tmp_path, capsys):
    base = [{"type": "text", "text": "T", "text_level": 1, "page_idx": 0}, {"type": "code", "code_body": "x=1", "bbox": [0, 0, 9, 9]}]
    model = [{"type": "code", "code_body": "x = 1", "bbox": [0, 0, 9, 9]}]
    for n, v in (("b", base), ("m", model)):
        (tmp_path / f"{n}.json").write_text(json.dumps(v))
    assert cli.main(["merge", f"file://{tmp_path}/b.json", f"file://{tmp_path}/m.json", "book", str(tmp_path / "out")]) == 0
    assert (tmp_path / "out/book.md").read_text() == "# T\n\n```\nx = 1\n```"
    assert cli.main(["clean", f"file://{tmp_path}/out/book.md", str(tmp_path / "ch"), "--apply"]) == 0
    assert (tmp_path / "ch/01-t.md").exists()
    assert cli.main(["flags", str(tmp_path / "out/blocks")]) == 0 and "code_blocks" in capsys.readouterr().out
    spark.createDataFrame([("f.pdf", 0, "A Good Title Here")], "book string, page int, text string").write.parquet(str(tmp_path / "p"))
    assert cli.main(["scan", str(tmp_path / "p")]) == 0 and "A Good Title Here" in capsys.readouterr().out
    with pytest.raises(SystemExit) as e:
        cli.main(["nothing"])
    assert e.value.code == 2
