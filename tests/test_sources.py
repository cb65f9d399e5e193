import json

import pytest
from pyspark.sql import functions as F

from foliate import api
from foliate.operators import inventory
from foliate.sources import files, policies, sinks

PDF = b"%PDF-1.7\n1 0 obj << /Type /Catalog >> 2 0 obj << /Type /Pages /Count 2 >> 3 0 obj << /Type /Page >> 4 0 obj << /Type /Page >> 5 0 obj << /Title (A \\(b\\)) /Author <FEFF00E7> >>"


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("docs")
    for path, content in (("Coll Á/a.pdf", PDF), ("Coll Á/sub/b.pdf", PDF + b" "), ("Coll Á/bad.pdf", b"no"), ("Coll Á/done/x.pdf", PDF), ("Coll Á/done/document.json", json.dumps({"document_id": "d", "stage_runs": [{"stage": "extract", "status": "ok"}, {"stage": "render", "status": "x"}]}).encode()), ("Coll Á/half/document.json", b"{")):
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(content)
    return str(root)


def test_pdf_inventory(spark, tree):
    rows = {r.collection_relative_path: r for r in files.pdf_inventory(spark, tree).collect()}
    assert set(rows) == {"a.pdf", "sub/b.pdf", "bad.pdf"}
    a = rows["a.pdf"]
    assert (a.page_count, a.title, a.author, a.pdf_version, a.encrypted, a.status, a.collection_slug) == (2, "A (b)", "ç", "1.7", False, "ok", "coll-a")
    assert rows["bad.pdf"].status == "error" and rows["bad.pdf"].sha256 and rows["bad.pdf"].page_count is None


def test_stages(spark, tree, tmp_path):
    inv = api.build_inventory(spark, tree, str(tmp_path))
    assert api.audit_inventory(inv, str(tmp_path))["unique_documents"] == 2
    assert api.select(inv, path="Coll Á/sub").count() == 1
    with pytest.raises(ValueError):
        api.select(inv, path="nowhere")
    assert api.sample(inv, 1).count() == 1
    assert api.snapshot(inv, str(tmp_path)).first().n == 2
    sinks.write_inventory(inv, str(tmp_path / "split"))
    assert {r.part: r["count"] for r in spark.read.parquet(str(tmp_path / "split")).groupBy("part").count().collect()} == {"inventory": 2, "errors": 1}


def test_manifests(spark, tree):
    assert {r.path.rsplit("/", 2)[1]: r.status for r in files.manifests(spark, tree).collect()} == {"done": "ok", "half": "pending"}


def test_two_regimes_of_csv(spark, tmp_path):
    (tmp_path / "i.csv").write_text('document_id,title,page_count\nd1,,3\nd2,"a ""b""\nc",\n')
    typed = files.csv_typed(spark, str(tmp_path / "i.csv"), "document_id string, title string, page_count int").collect()
    text = files.csv_strings(spark, str(tmp_path / "i.csv"), ["document_id", "title", "page_count"]).collect()
    assert [r.title for r in typed] == [None, 'a "b"\nc'] and [r.page_count for r in typed] == [3, None]
    assert [r.title for r in text] == ["", 'a "b"\nc'] and [r.page_count for r in text] == ["3", ""]


def test_json_lines(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    sinks.write_json_lines(df, str(tmp_path / "l"))
    assert files.json_lines(spark, str(tmp_path / "l"), "a int, b string").count() == 2
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\nnope\n')
    with pytest.raises(Exception):
        files.json_lines(spark, str(tmp_path / "bad.jsonl"), "a int").collect()


def test_content_list(spark):
    title = {"level": 1, "path": {"content": "no content"}, "title_content": [{"type": "text", "content": 'A "x"'}, {"content": ["B", 7]}]}
    payload = json.dumps([[3, {"type": "title", "bbox": [0, 1, 2, 3], "content": title}, {"type": 5, "bbox": [0, 1], "content": {"level": True}}], "no page", []])
    rows = files.content_list(spark.createDataFrame([("d", payload), ("e", None), ("f", "{")], "doc string, payload string")).collect()
    good = [r for r in rows if not r.bad]
    assert [(r.doc, r.item, r.global_order, r.type, r.level, r.text_parts, r.bbox) for r in good] == [("d", "content-list-v2:p0000:i0001", 0, "title", 1, ['A "x"', "B"], [0.0, 1.0, 2.0, 3.0]), ("d", "content-list-v2:p0000:i0002", 1, None, None, [], None)]
    assert good[0].text == 'A "x" B' and [(r.page, r.ordinal) for r in rows if r.bad] == [(1, None)]


def test_plans(spark):
    a = spark.createDataFrame([("k1", "h", 1, "d"), ("k2", "h", 1, "d"), ("k3", None, None, "e")], "object_key string, sha256 string, size int, destination string")
    b = spark.createDataFrame([("k1", "h", 1), ("k2", "g", 1)], "object_key string, sha256 string, size int")
    assert sorted(r.object_key for r in sinks.upload_plan(a, b).collect()) == ["k2", "k3"]
    assert [r.destination for r in sinks.download_conflicts(a).collect()] == ["d"]


def test_logs(spark):
    df = files.log_lines(spark.createDataFrame([("state=up n=1 n=2 url=http://a?b=c free",), (None,)], "message string"))
    assert df.select(F.col("kv")["n"], F.col("kv")["url"], F.col("kv")["state"]).first() == ("2", "http://a?b=c", "up")


def test_small_files(tmp_path):
    sinks.write_json({"b": 1, "a": "é"}, str(tmp_path / "x" / "s.json"))
    assert json.loads((tmp_path / "x" / "s.json").read_text()) == {"a": "é", "b": 1}


def test_policies(spark, tmp_path):
    path = tmp_path / "policy.json"
    path.write_text(json.dumps({"roles": {"aside": "embed"}, "collections": {"a": {"chunk_size": 700, "chunk_overlap": 100}}, "documents": {"x/y.pdf": {"authors": ["Ana Souza"]}, "z.pdf": {"no_personal_author": True}}}))
    policy = policies.load(str(path))
    actions = {r.role: r.action for r in policies.role_actions(spark, policy).collect()}
    assert actions["aside"] == "embed" and actions["title"] == "placeholder" and len(actions) == 13
    assert [tuple(r) for r in policies.splitters(spark, policy).collect()] == [("a", "recursive", None, 700, 100)]
    assert {r.path: r.authors for r in policies.overrides(spark, policy).collect()} == {"x/y.pdf": ["Ana Souza"], "z.pdf": []}
    for bad, f in (({"roles": {"title": "burn"}}, policies.role_actions), ({"roles": {"odd": "embed"}}, policies.role_actions), ({"collections": {"a": {"chunk_size": 5, "chunk_overlap": 5}}}, policies.splitters), ({"documents": {"x": {}}}, policies.overrides)):
        with pytest.raises(ValueError):
            f(spark, bad)
    path.write_text("[1]")
    with pytest.raises(ValueError):
        policies.load(str(path))


def test_listings_and_columns(spark, tmp_path):
    (tmp_path / "l.tsv").write_text("a/b.pdf\t10\t2024\n/etc/x\t1\t2024\na/../b\t1\t2024\n")
    assert [(r.path, r.size, r.unsafe) for r in files.listing_tsv(spark, str(tmp_path / "l.tsv")).collect()] == [("a/b.pdf", 10, False), ("/etc/x", 1, True), ("a/../b", 1, True)]
    df = inventory.conform(spark.createDataFrame([("7", "x")], "n string, other string"), [("m", "double"), ("n", "int")])
    assert df.dtypes == [("m", "double"), ("n", "int")] and df.first() == (None, 7)
