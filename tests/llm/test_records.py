"""Mixing, WARC, chat formatting, the pipeline."""

import gzip
import hashlib
import random
import re
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from quire.llm import chat, decontam, mixing, near_dedup, pii, warc

from .helpers import ODD, SF, against_sql, table


def test_mix_against_sql(spark, monkeypatch):
    rng = random.Random(1)
    docs = [(i, " ".join("w" for _ in range(int(rng.paretovariate(0.7)) % 3000)), rng.choice(["a", "b", "b", "b", "c", "é", None])) for i in range(700)]
    d = table(spark, docs, "doc_id long, text string, source string")
    got, want = against_sql(spark, lambda documents: mixing.mix(documents).drop("copies"), mixing.OP4_SQL, documents=d)
    assert got == want
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)  # the salted way gives the same
    m = mixing.mix(d, keep=("text", "source"))
    names = ["doc_id", "size", "source_size", "taken", "target"]
    assert sorted((tuple(r[n] for n in names) for r in m.collect()), key=str) == got
    for r in m.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g"), F.max("size").alias("x"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect():
        assert abs(r["t"] - r["g"]) <= r["x"] and r["over"] <= 0


def test_mix_of_odd_rows(spark):
    d = table(spark, ODD).selectExpr("*", "CAST(NULL AS STRING) AS source", "1 AS u", "2 AS cls")
    r = mixing.mix(d).collect()
    assert len(r) == len(ODD) and all(x["target"] == sum(y["size"] for y in r) for x in r)
    assert mixing.mix(d.where("false")).count() == 0
    assert mixing.mix(d.where("text IS NULL")).count() == 2


def test_warc_round_trip(spark, tmp_path):
    rows = [(5, "u5", "same"), (2, "u2", "same"), (9, None, "same"), (1, "u1\r\nX: y", "other é"), (3, "", ""), (4, "u", None), (7, "big", "z" * 200_000), (None, "n", "same"), (2, "again", "same")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    r = warc.deduplicate(d.selectExpr("*", "1 AS digest"), f"file://{tmp_path}").collect()
    by = [(x["page_id"], x["record_type"], x["refers_to"], x["payload_bytes"]) for x in r]
    assert len(by) == len(rows)
    assert sum(b[1] == "response" for b in by if b[3] == 4) == 1 and {b[2] for b in by if b[1] == "revisit" and b[3] == 4} == {2}
    assert sorted(b for b in by if b[3] == 0) == [(3, "response", None, 0), (4, "revisit", 3, 0)]
    assert len({x["record_id"] for x in r}) == len(rows)
    kept = b"".join(gzip.decompress(p.read_bytes()) for p in Path(tmp_path, "kept").iterdir())
    assert kept.count(b"WARC-Type: revisit") == 5 and kept.count(b"\r\n\r\nsame") == 1 and b"\r\nX: y" not in kept
    ids = {t: set(re.findall(rb"WARC-Type: " + t + rb"\r\n(?:[^\r\n]+\r\n)*?WARC-Record-ID: ([^\r\n]+)", kept)) for t in (b"response", b"revisit")}
    told = re.findall(rb"WARC-Refers-To: ([^\r\n]+)", kept)
    assert len(told) == 5 and set(told) <= ids[b"response"] and len(ids[b"revisit"]) == 5
    few = warc.deduplicate(d, f"file://{tmp_path}/m", min_bytes=5).collect()
    assert all(x["record_type"] == "response" for x in few)
    assert warc.deduplicate(d.where("false"), f"file://{tmp_path}/e").count() == 0
    assert warc.payload_digest(b"") == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_chat_against_sql(spark):
    rows = [(1, 0, "system", "s<S>"), (1, 1, "user", "[INST]\\[\\<s>"), (1, 2, "assistant", "<\\/s></s>é"), (1, 2, "assistant", ""), (2, None, "tool", "[END]"), (2, 1, None, None), (3, 0, "assistant", None)]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    f = chat.format_turns(t.selectExpr("*", "1 AS formatted", "'z' AS tokens"))
    for r in f.collect():
        turns = []
        reader = chat.Reader(lambda *x: turns.append(x))
        for c in r["formatted"]:  # cut anywhere
            reader.feed(c)
        reader.close()
        assert len(turns) == 1 and turns[0][:2] in {(x[2] or "", x[3] or "") for x in rows} and turns[0][3] == (r["role"] == "assistant")
    want = {}
    for c, _, role, text in rows:
        h = want.setdefault(c, [0, hashlib.sha256()])
        h[0] += 1
        h[1].update(f"{role or ''}\n{text or ''}\n".encode())
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"]) for r in chat.read_back(f).collect()}
    assert {c: n for c, (n, _) in got.items()} == {c: h[0] for c, h in want.items()} and got[3] == (1, want[3][1].hexdigest())
    assert chat.read_back(chat.format_turns(t.where("false"))).count() == 0


def test_parts(spark):
    d = spark.createDataFrame([([{"type": "text", "text": "see "}, {"type": "image", "ref": "a.png", "width": 28, "height": 15}, None, {"type": "audio", "ref": "b.wav", "seconds": 1.5}, {"type": "document", "ref": "c.pdf", "pages": 2}, {"type": "odd", "text": "!"}, {"type": "text"}],), (None,)], f"p {chat.PARTS}")
    text, attached, tokens = chat.flatten(F.col("p"))
    a, b = d.select(text.alias("t"), attached.alias("a"), tokens.alias("n")).collect()
    assert a["t"] == "see <|image_1|><|audio_2|><|document_3|>!" and [(x["k"], x["ref"], x["tokens"]) for x in a["a"]] == [(1, "a.png", 4), (2, "b.wav", 38), (3, "c.pdf", 512)] and a["n"] == 554
    assert (b["t"], b["a"], b["n"]) == ("", [], 0)


def test_conversations_with_attachments(spark):
    image, audio = {"type": "image", "ref": "a.png", "width": 28, "height": 15}, {"type": "audio", "ref": "b.wav", "seconds": 1.5}
    says = lambda t: {"type": "text", "text": t}
    rows = [(1, 0, "user", [says("see "), image, says("</s>[INST]<|image_1|> and "), audio]), (1, 1, "assistant", [says("[END] ok")]), (1, 2, "tool[/ROLE]", [audio]), (2, 0, "assistant", None), (None, None, None, [])]
    f = chat.format_turns(spark.createDataFrame(rows, f"conv_id long, turn long, role string, p {chat.PARTS}"), parts=F.col("p"))
    got = {r["conv_id"]: r for r in chat.read_back(f.repartition(3)).collect()}
    text = "see <|image_1|></s>[INST]<|image_1|> and <|audio_2|>"
    assert got[1]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n[END] ok\ntool[/ROLE]\n<|audio_1|>\n".encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["n_attachments"], got[1]["attachment_tokens"], got[1]["loss_chars"]) == (3, 3, 4 + 38 + 38, 8)
    assert [(got[k]["n_turns"], got[k]["n_attachments"]) for k in (2, None)] == [(1, 0), (1, 0)]
    whole = chat.OPEN + "".join(r["formatted"] for r in f.where("conv_id = 1").orderBy("turn").collect())
    turns = []
    chat.Reader(lambda *x: turns.append(x)).feed(whole)
    assert turns == [("user", text, [("image", 1), ("audio", 2)], False), ("assistant", "[END] ok", [], True), ("tool[/ROLE]", "<|audio_1|>", [("audio", 1)], False)]


def test_pipeline_of_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, __key string, size int, copies string, label long"
    rows = [(1, "a b c", "en", "s", "k", 1, "x", 9), (1, "a b c", "en", "s", "k", 1, "x", 9), (None, "x y z", None, None, None, None, None, None), (2, None, "en", "s", "k", 1, "x", 9), (3, "", "en", "s", "k", 1, "x", 9), (4, "long " * 50_000 + "a.b@c.de", "en", "t", "k", 1, "x", 9), (None, None, None, None, None, None, None, None)]
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            docs = spark.createDataFrame([tuple(r) for r in out.collect()], out.schema)
            assert docs.columns[:8] == [x.split(" ")[0] for x in schema.split(", ")], name
        # only the repeated row goes
        assert docs.count() == (0 if not n else 6) and docs.columns[8:] == ["copies_", "taken"]
        assert {r["__key"] for r in docs.where("doc_id = 1").collect()} <= {"k"} and docs.where("text LIKE '%@%'").count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    at = [docs]
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, at[-1], SF)
        assert out.columns == docs.columns
        at.append(spark.createDataFrame(out.toPandas(), docs.schema))
    n = [d.count() for d in at]
    assert n[0] >= n[1] >= n[2] >= n[3] == n[4] > 0
    groups = near_dedup.near_duplicates(at[1])
    assert sorted(r[0] for r in at[2].select("doc_id").collect()) == sorted(r[0] for r in groups.select("component_id").distinct().collect())
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r[0] for r in decontam.decontaminate(at[2], bench).where("n_hit > 0").select("doc_id").collect()}
    assert {r[0] for r in at[3].select("doc_id").collect()} == {r[0] for r in at[2].select("doc_id").collect()} - bad
    assert pii.find(at[4], None).agg(F.sum(F.col("n_email") + F.col("n_ip") + F.col("n_card") + F.col("n_phone"))).first()[0] == 0
    mixed = corpus_pipeline.source_mix(spark, at[4], SF)
    assert mixed.where("copies < 1 OR copies > 3").count() == 0 and mixed.count() > 0
