import json
import random

from foliate.functions import deepjson
from foliate.operators import extras, ir, nested


def frame(spark, payloads):
    return spark.createDataFrame([(i, "d", "s", p, None) for i, p in payloads], "record_id long, document_id string, source_name string, payload string, received_at timestamp")


def keys(payload):
    return [(p, n) for p, n, *_ in nested.nodes_of(nested.parse(payload))]


def test_keys_of_irregular_lists():
    p = json.dumps({"pdf_info": None, "pages": [7, {"para_blocks": {"lines": [None, {"spans": {"text": "a"}}, "x"], "blocks": [{"lines": None}]}, "discarded_blocks": [3, {}], "preproc_blocks": [{"lines": []}]}]})
    assert keys(p) == [
        ("root", "p0001"), ("p0001", "p0001:b0000"), ("p0001:b0000", "p0001:b0000:b0000"), ("p0001:b0000", "p0001:b0000:l0001"),
        ("p0001:b0000:l0001", "p0001:b0000:l0001:s0000"), ("p0001", "p0001:d0001"),
    ]


def test_payload_itself_is_a_page():
    assert keys('{"para_blocks": [{}]}') == [("root", "p0000"), ("p0000", "p0000:b0000")]
    assert keys("{}") == [("root", "p0000")]


def test_no_nodes():
    for p in (None, "", "[1, 2]", "3", '{"pages": [{}', '{"a": NaN}', "[" * 100_000):
        assert nested.nodes_of(nested.parse(p)) == []


def test_deep_nesting():
    for n in (200, 5_000):
        p = '{"blocks": [' * n + "{}" + "]}" * n
        assert len(keys('{"para_blocks": [' + p + "]}")) == n + 2


def test_deep_payloads_are_kept(spark):
    """Valid nesting far beyond the parsers' own limits loses no node, no typed column and no key."""
    n = 20_000
    deep = "[" * n + "]" * n
    p = f'{{"pages": [{{"page": 3, "para_blocks": [{{"type": "text", "extra": {deep}, "bbox": [1, 2, 3, 4]}}]}}], "level": {{"a": {deep}}}}}'
    df = frame(spark, [(1, p), (2, p[:-1]), (3, '{"pages": [{}]}')])
    assert [(r.record_id, r.node) for r in nested.found(df).orderBy("record_id", "node").collect()] == [(1, "p0000"), (1, "p0000:b0000"), (3, "p0000")]
    (row,) = nested.level_table(df, "block").collect()
    assert row.type == "text" and row.bbox == [1, 2, 3, 4] and deep in row.fields
    assert {(r.record_id, r.valid_copies) for r in ir.record_status(df).collect()} == {(1, 1), (2, 0), (3, 1)}
    assert [(r.key, r.path, len(r.value)) for r in extras.key_paths(df, "record_id", "payload", "level").collect()] == [("1", "level", 2 * n + 6)]


def test_json_without_recursion_is_the_same_json():
    rng = random.Random(1)

    def made(k):
        if not k or rng.random() < 0.3:
            return rng.choice([1, -2.5, 1e10, 'a"b\n', "é", None, True, False, 0, ""])
        return [made(k - 1) for _ in range(rng.randrange(4))] if rng.random() < 0.5 else {rng.choice("abcdeé"): made(k - 1) for _ in range(rng.randrange(4))}

    for _ in range(400):
        v = made(5)
        t = json.dumps(v, indent=rng.choice([None, 1]))
        assert deepjson._loads_flat(t) == v
        i = rng.randrange(len(t) + 1)
        broken = t[:i] + rng.choice('{}[],:"1 x') + t[i + rng.randrange(2) :]
        assert _or_none(deepjson._loads_flat, broken) == _or_none(json.loads, broken)


def _or_none(f, text):
    try:
        return (f(text),)
    except ValueError:
        return None


def test_identical_subtrees_have_one_identity_and_position_counts(spark):
    same = {"type": "text", "lines": [{"spans": [{"text": "a"}, {"text": "b"}]}]}
    swapped = {"type": "text", "lines": [{"spans": [{"text": "b"}, {"text": "a"}]}]}
    df = frame(spark, [(1, json.dumps({"para_blocks": [same, same, swapped]}, indent=2)), (2, json.dumps({"para_blocks": [same]}))])
    rows = {(r.record_id, r.node): r.object_id for r in nested.occurrences(df).collect()}
    assert rows[1, "p0000:b0000"] == rows[1, "p0000:b0001"] == rows[2, "p0000:b0000"] != rows[1, "p0000:b0002"]
    store = nested.objects(df).collect()
    assert len(store) == len({r.object_id for r in store}) == len(set(rows.values()))
    assert sum(r.n_occurrences for r in store) == len(rows)


def test_records_sent_twice_and_empty_table(spark):
    p = json.dumps({"pages": [{"para_blocks": [{}]}]})
    assert nested.found(frame(spark, [(1, p), (1, " " + p), (2, None)])).count() == 2
    assert nested.found(frame(spark, [])).count() == 0
    assert ir.counts(frame(spark, [(1, p)])).first().content_blocks == 1


def test_extra_columns(spark):
    df = frame(spark, [(1, "{}")]).selectExpr("*", "1 as node", "2 as parent", "3 as kind")
    assert nested.found(df).columns == ["record_id", "parent", "node"]


def test_all_keys_count(spark):
    p = json.dumps({"version": 1, "pages": [{"para_blocks": [{"type": "text", "lines": [{"spans": [{"text": "a"}, {"text": "b"}]}], "blocks": []}], "preproc_blocks": []}]})
    got = {(r.kind, r.key): (r.n, r.documents) for r in nested.key_counts(frame(spark, [(1, p), (2, p), (3, None), (4, "{")])).collect()}
    want = {("root", "version"): 2, ("root", "pages"): 2, ("page", "para_blocks"): 2, ("page", "preproc_blocks"): 2, ("block", "type"): 2, ("block", "lines"): 2, ("block", "blocks"): 2, ("line", "spans"): 2, ("span", "text"): 4}
    assert got == {k: (n, 1) for k, n in want.items()}
    one = {(r.record_id, r.kind, r.key): r.n for r in nested.record_key_counts(frame(spark, [(1, p), (2, p)])).collect()}
    assert one == {(i, *k): n // 2 for k, n in want.items() for i in (1, 2)}
    inventory = spark.createDataFrame([("d", "c1"), ("d", "c2")], "document_id string, collection_slug string")
    assert {(r.collection_slug, r.kind, r.key): (r.n, r.documents) for r in nested.collection_key_counts(frame(spark, [(1, p), (2, p)]), inventory).collect()} == {(c, *k): (n, 1) for k, n in want.items() for c in ("c1", "c2")}


def test_what_is_no_node_is_part_of_the_identity():
    def ids(page):
        return [(i, f) for *_, i, f in nested.nodes_of({"pages": [page]})]

    plain = {"para_blocks": [{"type": "text"}]}
    (page, fields), _ = ids({**plain, "preproc_blocks": [{"type": "x"}]})
    assert page != ids(plain)[0][0] and json.loads(fields)["preproc_blocks"] == [{"type": "x"}]
    (page, fields), _ = ids({"para_blocks": [{"type": "text"}, 7]})
    assert page != ids(plain)[0][0] and json.loads(fields)["para_blocks"] == [{}, 7]
