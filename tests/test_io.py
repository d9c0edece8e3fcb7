import json

import pytest

from clauseworks.plans import pipeline
from clauseworks.sources import readers, writers
from clauseworks.streaming import ingest


def test_readers(spark, tmp_path):
    (tmp_path / "metadata").mkdir()
    (tmp_path / "drafts").mkdir()
    (tmp_path / "provisions").mkdir()
    (tmp_path / "tags").mkdir()
    (tmp_path / "metadata/a.yaml").write_text("title: 标题\nocr_required: true\n")
    (tmp_path / "metadata/b.yaml").write_text("- a list\n")
    (tmp_path / "drafts/a.md").write_text("---\ntitle: T\n---\n\nbody\n")
    (tmp_path / "drafts/c.md").write_text("---\nnever closed\n")
    (tmp_path / "provisions/a.jsonl").write_text('{"provision_id": "p"}\n\nnot json\n')
    (tmp_path / "tags/a.json").write_text(json.dumps({"document_id": "a", "provisions": [{"id": "p", "topics": ["x"], "entities": []}]}))
    t = readers.record_folder(spark, str(tmp_path))
    meta = {r["document_id"]: r for r in t["metadata"].collect()}
    assert meta["a"]["title"] == "标题" and meta["a"]["ocr_required"] is True and meta["b"]["title"] is None
    drafts = {r["document_id"]: r for r in t["drafts"].collect()}
    assert drafts["a"]["header"] == {"title": "T"} and drafts["a"]["body"] == "body\n" and drafts["c"]["body"].startswith("---")
    assert [r["corrupt"] for r in t["provisions"].orderBy("corrupt").collect()] == [None, "not json"]
    assert t["requirements"].count() == 0
    assert [(r["id"], r["topics"]) for r in t["tags"].collect()] == [("p", ["x"])]
    with pytest.raises(FileNotFoundError):
        readers.jsonl(spark, str(tmp_path / "none"), readers.PROVISIONS, strict=True)
    with pytest.raises(KeyError):
        readers.table_rows(spark, "no_such_table")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("b", None, "x|y"), ("a", "d", "z")], "document_id string, day string, title string")
    writers.jsonl(df, str(tmp_path / "j"), sort_keys=True)
    assert sorted(r["value"] for r in spark.read.text(str(tmp_path / "j")).collect()) == ['{"day":"d","document_id":"a","title":"z"}', '{"day":null,"document_id":"b","title":"x|y"}']
    writers.index(df, ("document_id", "day", "title"), "document_id", str(tmp_path / "i"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "i")).collect()] == ["| a | d | z |", "| b | — | x\\|y |"]
    assert writers.export_tables({"t": df}, str(tmp_path / "e")) == {"t": 2}
    assert writers.export_tables({"t": df.limit(1)}, str(tmp_path / "e")) == {"t": 1}
    assert writers.export_json({"t": df}, str(tmp_path / "x")) == {"t": 2}
    assert df.select(writers.yaml_record(("document_id", "day")).alias("y")).first()["y"] == 'document_id: "b"\nday: null'


def test_pipeline(spark):
    texts = spark.createDataFrame([("d", "raw/gb-1-2017.pdf", "# T\nGB 7258-2017\n1 A\nshall not\n"), ("e", "raw/x", None)], "document_id string, raw_path string, text string")
    rows = {r["document_id"]: r for r in pipeline.ingest_texts(texts).collect()}
    assert rows["d"]["title"] == "T" and rows["d"]["status"] == "completed" and rows["e"]["status"] == "failed"
    out = pipeline.compile_run(spark.createDataFrame([(1, "d", "1 A\nshall not\n2 B", None)], "doc_id long, document_id string, text string, ingested_at timestamp"))
    assert out["report"].first().asDict() == {"document_id": "d", "n_provisions": 2, "n_requirements": 1, "status": "completed"}
    page = pipeline.ingest_pages(spark.createDataFrame([("https://h.org/News%20One.html?x=1", "<title>N</title><h1>H</h1><a href='a.pdf'>")], "url string, html string")).first()
    assert page["document_id"] == "news-20one" and page["attachments"] == ["https://h.org/a.pdf"]


def test_streaming(spark, tmp_path):
    schema = "doc_id long, document_id string, text string, ingested_at timestamp"
    src, out, mark = (str(tmp_path / x) for x in ("src", "out", "mark"))
    for i in range(2):
        spark.createDataFrame([(i, f"d{i}", "1 a shall\n2 b\n", None)], schema).write.mode("append").parquet(src)
        q = ingest.ingest(ingest.document_stream(spark, src, spark.read.parquet(src).schema), out, mark)
        q.awaitTermination(60)
    assert spark.read.parquet(f"{out}/provisions").count() == 4
    assert spark.read.parquet(f"{out}/requirements").count() == 2


def test_command_line(spark, tmp_path, capsys):
    import json

    from clauseworks import cli

    sf = "/root/testdata/sf0.001"
    good, bad = tmp_path / "good.jsonl", tmp_path / "bad.jsonl"
    rows = [{"id": "n", "type": "sqlite_table_row_count", "expected": {"table": "documents", "min_count": 1}}, {"id": "w", "type": "sqlite_table_row_count", "severity": "warn", "expected": {"table": "none"}}]
    good.write_text("\n".join(map(json.dumps, rows)))
    bad.write_text(json.dumps({"id": "x", "type": "keyword_search", "expected": {"keyword": "zzzz", "min_count": 1}}))
    assert cli.main(["check", sf, str(good)]) == 0 and "warn\tw" in capsys.readouterr().out
    assert cli.main(["check", sf, str(good), str(bad)]) == 1 and "error\tx" in capsys.readouterr().out
    assert cli.main(["jobs", sf, "--status", "failed"]) == 0 and "failed" in capsys.readouterr().out
    assert cli.main(["review", sf, str(tmp_path / "m")]) == 0 and spark.read.json(str(tmp_path / "m")).count() > 0
