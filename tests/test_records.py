import pytest
from pyspark.sql import functions as F

from clauseworks.operators import checks, collect, graph, quality, search

LOC = "struct<label:string,occurrence:int,source_offset:int>"
P = f"document_id string, provision_id string, label string, title string, text string, locator {LOC}, evidence struct<quote:string>, confidence string, review_status string, ingested_at timestamp"
R = "document_id string, provision_id string, requirement_id string, modality string, subject string, action string, object string, evidence_quote string, review_status string, ingested_at timestamp"
D = "doc_id long, document_id string, title string, standard_id string, raw_path string, replaces string, review_status string, text string, source_text string"
G = "document_id string, id string, topics array<string>, entities array<string>"


def prov(i, label="1", text="text here", doc="d1", at=0):
    return (doc, i, label, "t", text, (label, 1, at), (text,), "low", "draft", None)


def req(i, p="p1", modality="must", quote="a shall b", doc="d1"):
    return (doc, p, i, modality, "unknown", "unknown", "unknown", quote, "draft", None)


@pytest.fixture
def t(spark):
    return {
        "documents": spark.createDataFrame([(1, "d1", "Brake rules", "GB 1", "raw/a", "d0", "draft", "x", None), (2, "d0", None, None, None, "d00", "draft", None, None)], D),
        "provisions": spark.createDataFrame([prov("p1"), prov("p2", "1.1", "ab", at=5), prov("p3", "1.1", "1.1 Scope .... 5", at=9), prov("p4", "fallback", None, "d2"), prov(None)], P),
        "requirements": spark.createDataFrame([req("r1"), req("r2", quote=None), req("r3", quote="x", p="p9")], R),
        "tags": spark.createDataFrame([("d1", "p1", ["seats"], ["vehicle"]), ("d1", "r1", [], [])], G),
    }


def test_audit(t):
    row = {r["document_id"]: r.asDict() for r in quality.audit(t["provisions"], t["requirements"]).collect()}
    assert row["d1"] == {"document_id": "d1", "n_fallback": 0, "n_short": 1, "n_duplicate_labels": 2, "n_toc": 1, "n_weak": 2, "n_issues": 6}
    assert row["d2"]["n_fallback"] == 1 and row["d2"]["n_short"] == 1
    assert {(r["id"], r["message"]) for r in quality.validate_requirements(t["requirements"]).collect()} == {("r2", "missing quote")}
    assert ("error", 1) in {(r["level"], r["count"]) for r in quality.validate_provisions(t["provisions"]).where("message = 'missing provision_id'").groupBy("level").count().collect()}


def test_keyword_counts(t):
    got = {r["keyword"]: r["n"] for r in quality.keyword_counts(t["provisions"], t["requirements"], ["shall", "te"]).collect()}
    assert got == {"shall": 1, "te": 4}


def test_search(t):
    hits = search.substring_search(t["documents"], t["provisions"], t["requirements"], "BRAKE").collect()
    assert [(r["id"], r["matched_field"]) for r in hits] == [("d1", "title")]
    assert search.substring_search(t["documents"], t["provisions"], t["requirements"], "").count() == 0
    assert [r["id"] for r in search.search_mode(t["provisions"], "provisions", "TEXT here").collect()] == ["p1"]
    assert [r["id"] for r in search.search_mode(t["provisions"], "provisions", "text", tags=t["tags"], topic="seats", entity="vehicle").collect()] == ["p1"]
    assert search.search_mode(t["documents"], "documents", "brake", tags=t["tags"], topic="seats").count() == 0
    assert search.search_all(t, "a").count() > 2
    with pytest.raises(ValueError):
        search.search_mode(t["documents"], "pages", "x")
    with pytest.raises(ValueError):
        search.terms_of("a OR b")
    scores = search.bm25(t["provisions"], "provision_id", "text", "text").collect()
    assert [r["id"] for r in scores] == ["p1"]


def test_graph(t):
    args = t["documents"], t["provisions"], t["requirements"], t["tags"]
    nodes, edges = graph.nodes(*args), graph.edges(*args)
    ids = [r["id"] for r in nodes.collect()]
    assert sorted(ids) == sorted(["d0", "d00", "d1", "p1", "p2", "p3", "p4", "r1", "r2", "r3", "topic:seats", "entity:vehicle"])
    assert {(r["source"], r["target"]) for r in edges.where("type = 'SUBSECTION_OF'").collect()} == {("p2", "p1"), ("p3", "p1")}
    assert {(r["source"], r["missing"]) for r in graph.dangling(nodes, edges).collect()} == {("d2", "d2"), ("p9", "p9")}
    _, kept = graph.assemble(nodes, edges)
    assert graph.dangling(nodes, kept).count() == 0
    assert {(r["document_id"], r["ancestor"], r["steps"]) for r in graph.version_chains(t["documents"]).collect()} == {("d1", "d0", 1), ("d1", "d00", 2), ("d0", "d00", 1)}
    assert {(r["source"], r["target"]) for r in graph.neighbours(t["provisions"]).collect()} == {("p1", "p2"), ("p2", "p3")}


@pytest.mark.parametrize("block", [1, 7, 10**6])
def test_neighbours_across_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(graph, "BLOCK", block)
    at = [0, 3, 3, 8, 30, 31, None]
    rows = spark.createDataFrame([prov(f"p{i}", at=x) for i, x in enumerate(at)] + [prov("q", doc="d2")], P)
    assert sorted((r["source"], r["target"]) for r in graph.neighbours(rows).collect()) == [("p0", "p1"), ("p1", "p2"), ("p2", "p3"), ("p3", "p4"), ("p4", "p5"), ("p6", "p0")]


def test_version_cycle_ends(spark):
    docs = spark.createDataFrame([(1, "a", None, None, None, "b", None, None, None), (2, "b", None, None, None, "a", None, None, None)], D)
    assert graph.version_chains(docs).count() == 2


def test_checks(spark, t):
    rows = [
        ("1", "document_id_exists", "error", {"document_id": "d1"}), ("2", "provision_label_exists", "error", {"document_id": "d1", "label": "9"}),
        ("3", "metadata_field_equals", "warn", {"document_id": "d0", "field": "title", "value": None}), ("4", "topic_tag_exists", None, {"document_id": "d1", "topic": "seats"}),
        ("5", "evidence_quote_exists", "error", {"document_id": "d1", "quote_substring": "here"}), ("6", "nonsense", "error", None),
        ("7", "graph_node_exists", "error", {"id": "p1", "type": "Provision"}), ("8", "graph_edge_exists", "error", {"source": "d1", "target": "p1", "type": "HAS_PROVISION"}), ("9", "graph_edge_integrity", "error", {}),
        ("10", "sqlite_table_row_count", "error", {"table": "documents", "min_count": "2"}), ("11", "requirement_modality_exists", "error", {"document_id": "d1", "modality": "must"}),
        ("12", "sqlite_fts_result", "error", {"query": "text", "mode": "provisions", "min_count": "1"}), ("13", "keyword_search", "error", {"keyword": "te", "min_count": "9"}),
    ]
    args = t["documents"], t["provisions"], t["requirements"], t["tags"]
    out = checks.run(spark.createDataFrame(rows, checks.SCHEMA), t, graph.nodes(*args), graph.edges(*args))
    passed = {r["id"]: r["passed"] for r in out.collect()}
    assert passed == {"1": True, "2": False, "3": True, "4": True, "5": True, "6": False, "7": True, "8": True, "9": False, "10": True, "11": True, "12": True, "13": False}
    assert checks.totals(out).first().asDict() == {"total": 13, "n_passed": 9, "n_failed": 4}


def test_checks_with_conditions(spark, t):
    quote = lambda i, **e: (i, "evidence_quote_exists", None, {"document_id": "d1", **e})
    rows = [
        quote("label", quote_substring="ab", label="1.1"), quote("no label", quote_substring="ab", label="9"), quote("id", quote_substring="shall", id="r1"), quote("no id", quote_substring="shall", id="r2"), quote("empty", quote_substring=""),
        quote("within", quote_substring="shall", label="p1"), ("number", "metadata_field_equals", None, {"document_id": "GB 1", "field": "title", "value": "Brake rules"}), ("field", "metadata_field_equals", None, {"document_id": "d1", "field": "none", "value": None}),
        ("nobody", "metadata_field_equals", None, {"document_id": "zz", "field": "title", "value": None}), ("mode", "sqlite_fts_result", None, {"query": "a", "mode": "pages", "min_count": "1"}), ("all", "sqlite_fts_result", None, {"query": "shall", "min_count": "1"}),
    ]
    passed = {r["id"]: r["passed"] for r in checks.run(spark.createDataFrame(rows, checks.SCHEMA), t).collect()}
    assert passed == {"label": True, "no label": False, "id": True, "no id": False, "empty": False, "within": True, "number": True, "field": True, "nobody": False, "mode": False, "all": True}
    assert checks.run(spark.createDataFrame([], checks.SCHEMA), t).count() == 0


def test_job_states(spark):
    jobs = spark.createDataFrame([], ", ".join(f"{c} string" for c in checks.JOB_COLUMNS))
    jobs = checks.created_jobs(jobs, spark.createDataFrame([("a", "pdf", "x"), ("b", "pdf", "y")], "job_id string, input_type string, input string"), "2024-01-01")
    jobs, missing = checks.updated_jobs(jobs, spark.createDataFrame([("a", "failed", "bad"), ("z", "running", None)], "job_id string, status string, error string"), "2024-01-02")
    assert [r[0] for r in missing.collect()] == ["z"] and checks.job(jobs, "z") is None
    assert checks.job(jobs, "a") == {"job_id": "a", "input_type": "pdf", "input": "x", "status": "failed", "created_at": "2024-01-01", "updated_at": "2024-01-02", "error": "bad"}
    assert [r["job_id"] for r in checks.listed_jobs(jobs, "pending").collect()] == ["b"] and checks.listed_jobs(jobs).count() == 2
    with pytest.raises(Exception, match="unknown job status"):
        checks.updated_jobs(jobs, spark.createDataFrame([("a", "lost", None)], "job_id string, status string, error string"), "2024-01-03")[0].collect()


def test_manifest_round_trip_and_pages(spark, t, tmp_path):
    manifest = checks.review_manifest(t["provisions"])
    checks.save_manifest(manifest, str(tmp_path / "m"))
    back = checks.load_manifest(spark, str(tmp_path / "m"))
    assert sorted(map(tuple, back.collect())) == sorted(tuple(r) for r in manifest.select(*back.columns).collect())
    assert {r["provision_id"]: r["locator"] for r in back.collect()}["p2"] == "1.1@5"
    done, _ = checks.promote(checks.mark_reviewed(manifest, spark.createDataFrame([("p2",)], "provision_id string")), t["provisions"])
    assert [tuple(r) for r in checks.reviewed_pages(done, t["provisions"]).collect()] == [("p2", "---\nprovision_id: p2\nreview_status: reviewed\n---\n\n# 1.1\n\nab")]


def test_long_chains_and_first_nodes(spark):
    docs = spark.createDataFrame([(i, f"d{i}", None, None, None, f"d{i + 1}", None, None, None) for i in range(12)], D)
    assert graph.version_chains(docs).agg({"steps": "max"}).first()[0] == 12
    nodes = spark.createDataFrame([("x", "Topic", "t"), ("x", "Document", None), ("x", "Provision", "p")], "id string, type string, name string")
    assert [tuple(r) for r in graph.assemble(nodes, spark.createDataFrame([], "source string, target string, type string"))[0].collect()] == [("x", "Document", None)]


def test_review_and_jobs(spark, t):
    marked = checks.mark_reviewed(checks.review_manifest(t["provisions"]), spark.createDataFrame([("p1",), ("zz",)], "provision_id string"))
    assert {r["provision_id"]: r["review_status"] for r in marked.collect()} == {"p1": "reviewed", "p2": "pending", "p3": "pending", "p4": "pending"}
    done, missing = checks.promote(marked.union(spark.createDataFrame([("zz", None, None, None, None, None, "reviewed")], marked.schema)), t["provisions"])
    assert [r["provision_id"] for r in done.collect()] == ["p1"] and [r["provision_id"] for r in missing.collect()] == ["zz"]
    jobs = spark.createDataFrame([("j", "running", "2024-01-01", "2024-01-02", None, "i"), ("j", "completed", "2024-01-01", "2024-01-03", None, "i"), ("k", "failed", "2024-01-01", None, "e", "i")], "job_id string, status string, created_at string, updated_at string, error string, input string")
    assert {r["job_id"]: r["status"] for r in checks.latest_jobs(jobs).collect()} == {"j": "completed", "k": "failed"}


def test_collect(spark, t):
    tags = collect.requirement_tags(t["requirements"], t["tags"]).collect()
    assert {r["requirement_id"]: r["topics"] for r in tags} == {"r1": [], "r2": ["seats"], "r3": []}  # an own empty record blocks the fallback
    assert collect.duplicate_ids(t["provisions"], "label", "label", True).count() == 2
    pages = {r["provision_id"]: r["page"] for r in collect.rendered_provisions(t["provisions"].where("provision_id is not null"), t["requirements"]).collect()}
    assert "- r1: must\n- r2: must" in pages["p1"] and pages["p2"].endswith("ab\n\n")
    empty = spark.createDataFrame([], D)
    assert collect.fingerprints(empty).count() == 0 and collect.manifest({"d": empty}).first()["n_rows"] == 0


def test_postings(spark):
    df = spark.createDataFrame([("a", "Brake bearing", "x"), ("b", "be ar ing", "x"), ("c", None, "x"), ("a", "Brake bearing", "x"), ("d", "ab", "x"), ("e", "bearing " * 9000, "x")], "k string, t string, gram string")
    index = search.postings(df, "k", "t")
    assert {r["id"] for r in search.search_postings(index, df, "k", "t", "BEAR").collect()} == {"a", "e"}
    assert search.search_postings(index, df, "k", "t", "xyz").count() == 0
    with pytest.raises(ValueError):
        search.search_postings(index, df, "k", "t", "ab")
