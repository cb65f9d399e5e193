import json
import random
import uuid

import pytest
from pyspark.sql import functions as F

from foliate.functions import geometry, identity, text, tokenizer
from foliate.operators import audit, bibliography, catalog, chunking, extras, inventory, nested, ordering, reconcile, render, runs, state, structure, vectors

BLOCK = "block_id string, document_id string, reading_order int, role string, source_type string, text string, page int, section_id string, char_count int, asset_ids array<string>, loaded_at timestamp"


def blocks(spark, rows):
    return spark.createDataFrame([(b, d, o, r, r, t, 0, None, None, None, None) for b, d, o, r, t in rows], BLOCK)


def test_uuid5(spark):
    ns = uuid.UUID(identity.NAMESPACE)
    names = ["document:a:b.pdf", "ação", "", "x" * 500]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", identity.uuid5(identity.NAMESPACE, F.col("n")).alias("u"))
    assert {r.n: r.u for r in df.collect()} == {n: str(uuid.uuid5(ns, n)) for n in names}


def test_slug_and_path(spark):
    df = spark.createDataFrame([("Acervo — São João ß", "a\\b//c.pdf/"), ("***", "../x"), (None, None)], "c string, p string")
    assert [tuple(r) for r in df.select(identity.slug(F.col("c")), identity.relative_path(F.col("p"))).collect()] == [("acervo-sao-joao-ss", "a/b/c.pdf"), (None, None), (None, None)]


def test_iou(spark):
    df = spark.createDataFrame([([0.0, 0.0, 2.0, 2.0], [1.0, 1.0, 3.0, 3.0]), ([0.0, 0.0, 0.0, 0.0], [0.0, 0.0, 0.0, 0.0]), (None, [0.0, 0.0, 1.0, 1.0])], "a array<double>, b array<double>")
    assert [round(r[0], 6) for r in df.select(geometry.iou(F.col("a"), F.col("b"))).collect()] == [round(1 / 7, 6), 0.0, 0.0]


def test_keep_and_collisions(spark):
    cols = "document_id string, sha256 string, path string, modified_at string, revision_id string, status string, page_count int"
    a = spark.createDataFrame([("d", "h", "p", "2024-01-01T00:00:00Z", "r1", "ok", 1), ("d", "h", "p", "2024-01-01T00:00:00+02:00", "r2", "ok", 1), ("", "h", "q", None, None, "error", None), ("e", "g", "P", None, "r3", "ok", 2)], cols)
    assert [r.revision_id for r in inventory.keep(a.where("document_id = 'd'"), ["document_id"], True).collect()] == ["r1"]
    assert inventory.physical_collisions(a).count() == 1
    assert inventory.logical_collisions(a).first().revisions == "r1,r2"
    assert inventory.audit(a.limit(0)).first().inventory_rows in (0, None)
    with pytest.raises(ValueError):
        inventory.require_columns(a)
    with pytest.raises(inventory.SelectionError):
        inventory.select(a, "x", "y")


def test_fingerprint_does_not_depend_on_partitioning(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("document_id"), F.lit(None).cast("string").alias("revision_id"), F.sha2(F.col("id").cast("string"), 256).alias("sha256"))
    assert inventory.fingerprint(df.repartition(1)).first() == inventory.fingerprint(df.repartition(7, "sha256")).first()


def test_merged_order(spark):
    # physical a b c d; the second reading has d first, then b: c goes before d, a before b
    df = spark.createDataFrame([("p", i, n, o) for i, (n, o) in enumerate([("a", None), ("b", 1), ("c", None), ("d", 0)])], "g string, i int, n string, o int")
    got = structure.merged_order(df, ["g"], "i", "o").orderBy("merged").collect()
    assert [r.n for r in got] == ["c", "d", "a", "b"]


def merged_by_hand(order, matched):
    ranked = sorted(matched, key=lambda n: (matched[n], order.index(n)))
    before = {n: [] for n in ranked}
    tail = []
    for i, n in enumerate(order):
        if n not in matched:
            nxt = next((m for m in order[i + 1 :] if m in matched), None)
            (before[nxt] if nxt else tail).append(n)
    return [x for n in ranked for x in [*before[n], n]] + tail


def test_merged_order_at_random(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for g in range(60):
        order = list(range(rng.randrange(1, 9)))
        matched = {n: rng.randrange(4) for n in order if rng.random() < 0.5}
        rows += [(g, i, n, matched.get(n)) for i, n in enumerate(order)]
        want[g] = merged_by_hand(order, matched)
    got = {}
    for r in structure.merged_order(spark.createDataFrame(rows, "g int, i int, n int, o int"), ["g"], "i", "o").orderBy("g", "merged").collect():
        got.setdefault(r.g, []).append(r.n)
    assert got == want


def test_sections_follow_the_stack(spark):
    rng = random.Random(2)
    rows, want = [], {}
    for d in range(40):
        stack = []
        for i in range(rng.randrange(1, 15)):
            b = f"d{d:02d}b{i:02d}"
            level = 1 if i == 0 else rng.choice([2, 3, 4])
            rows.append((b, f"d{d}", i, "title", "T" if level in (1, 2) else "1." * (level - 2) + "1 T"))
            while stack and stack[-1][0] >= level:
                stack.pop()
            want[b] = stack[-1][1] if stack else None
            stack.append((level, b))
    got = {r.block_id: r.parent for r in structure.sections(blocks(spark, rows)).collect()}
    assert got == want


def test_list_islands(spark):
    rows = [(f"b{i}", "d", i, r, "x") for i, r in enumerate(["title", "list", "list", "body", "list", "title", "list", "list"])]
    assert sorted(r.n_blocks for r in structure.list_groups(blocks(spark, rows)).collect()) == [1, 2, 2]


def test_region_closes_at_the_next_title(spark):
    rows = [("a", "d", 0, "title", "Paper"), ("b", "d", 1, "title", "References."), ("c", "d", 2, "list", "x"), ("e", "d", 3, "title", "Appendix"), ("f", "d", 4, "body", "y")]
    got = {r.block_id: r.final_role for r in structure.regions(blocks(spark, rows)).collect()}
    assert (got["c"], got["f"]) == ("reference", "body")


def one_space(box):
    return reconcile.box_candidates(box, None)


def test_greedy_keeps_the_earlier_item():
    box = [0.0, 0.0, 10.0, 10.0]
    made = reconcile.assign([("i1", "title", one_space(box), "abc"), ("i2", "title", one_space(box), "abcd")], [("b1", "title", box, "abcd")])
    assert [(m.item, m.block) for m in made] == [("i1", "b1"), ("i2", None)]


def test_ambiguity():
    box = [0.0, 0.0, 10.0, 10.0]
    (m,) = reconcile.assign([("i", "title", one_space(box), "abc")], [("b1", "title", box, "abc"), ("b2", "title", box, "abc")])
    assert m.block == "b1" and m.ambiguous and not m.usable and m.margin == 0.0
    # a rival counts even if it could not be accepted itself: overlaps of 0.67 and 0.62, no texts
    (m,) = reconcile.assign([("i", None, one_space([0.0, 0.0, 100.0, 100.0]), "")], [("b1", None, [0.0, 0.0, 67.0, 100.0], ""), ("b2", None, [0.0, 0.0, 62.0, 100.0], "")])
    assert m.block == "b1" and m.ambiguous and m.margin == 0.0275


def test_boxes_on_the_grid_of_a_thousand():
    block = [59.5, 84.2, 297.5, 421.0]
    (m,) = reconcile.assign([("i", "title", reconcile.box_candidates([100.0, 100.0, 500.0, 500.0], (595.0, 842.0)), "")], [("b", "title", block, "")])
    assert m.space == "normalized_0_1000" and m.iou == 1.0 and m.usable
    for bad in (None, [1.0, 2.0], [5.0, 0.0, 1.0, 1.0], [-1.0, 0.0, 1.0, 1.0], [0.0, 0.0, float("nan"), 1.0]):
        assert not bad or len(bad) != 4 or reconcile.box_candidates(bad, (10.0, 10.0)) == []


def test_bounds_change_no_assignment():
    rng = random.Random(6)

    def all_compared(items, blocks):
        free, out = list(range(len(blocks))), []
        for item, kind, boxes, words in items:
            ranked = []
            for i in free:
                b, own, where, other = blocks[i]
                _, iou = reconcile.overlap(boxes, where)
                ratio = text.sequence_ratio_of(words, other) if words and other else 0.0
                w = reconcile.WEIGHTS
                ranked.append((-(w[0] * iou + w[2] * (own in reconcile.COMPATIBLE.get(kind, ())) + w[1] * ratio), -iou, -ratio, b, i))
            ranked.sort()
            if not ranked or -ranked[0][0] < reconcile.ACCEPT:
                out.append((item, None, None, False))
                continue
            free.remove(ranked[0][4])
            margin = (ranked[1][0] if len(ranked) > 1 else 0.0) - ranked[0][0]
            out.append((item, ranked[0][3], round(margin, 6), len(ranked) > 1 and margin < reconcile.MARGIN and -ranked[1][1] >= reconcile.RIVAL))
        return out

    def box(side):
        x, y = rng.randrange(side), rng.randrange(side)
        return rng.choice([None, [float(x), float(y), x + 10.0, y + 10.0]])

    words = lambda: rng.choice([None, "", "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 25)))])
    for k in range(600):
        side = rng.choice([3, 6, 20])  # small ones give overlaps, and so scores, near every threshold
        items = [(f"i{k}", rng.choice(["title", "paragraph"]), reconcile.box_candidates(box(side), rng.choice([None, (500.0, 800.0)])), words()) for k in range(rng.randrange(1, 7))]
        blocks_ = [(f"b{k}", rng.choice(["title", "text"]), box(side), words()) for k in range(rng.randrange(0, 7))]
        assert [(m.item, m.block, m.margin, m.ambiguous) for m in reconcile.assign(items, blocks_)] == all_compared(items, blocks_)


def test_breaker():
    b = runs.Breaker()
    for t in (0, 30):
        assert b.see(t, True) is None
    assert b.see(61, True) is None  # the failure at 0 has left the window
    assert b.see(62, True) == "open"
    assert b.see(93, False) == "half_open"
    assert b.see(94, False) == "closed"


def test_leases():
    assert runs.fold_leases([(0, "a"), (10, "b"), (20, "a"), (400, "b")], 300) == [(0, "a", True, 1), (10, "b", False, 1), (20, "a", True, 1), (400, "b", True, 2)]


def test_chunk_tail_joins_the_chunk_before():
    assert chunking.pack_units([("a", 2200), ("b", 150), ("c", 100)]) == [["a", "b", "c"]]
    # a unit joins before the target closes the chunk; the last one opens the next again
    assert chunking.pack_units([("a", 1500), ("b", 1500), ("c", 500)]) == [["a", "b"], ["b", "c"]]
    assert chunking.pack_units([("a", 2400), ("b", 1000)]) == [["a"], ["a", "b"], ["b"]]
    assert chunking.pack_units([("a", 2000), ("b", 1700)]) == [["a"], ["a", "b"], ["b"]]
    assert chunking.pack_units([]) == []


def test_recursive_split_loses_nothing():
    rng = random.Random(3)
    for _ in range(200):
        t = "".join(rng.choice("ab .\n") for _ in range(rng.randrange(0, 200)))
        pieces = chunking.split_recursively(t, 17)
        assert "".join(pieces) == t and all(len(p) <= 17 for p in pieces)


def test_merge_and_diff(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(2, "z"), (3, None)], "k int, v string")
    assert {(r.k, r.v, r.action) for r in catalog.merge(a, b, ["k"], ["v"]).collect()} == {(1, "x", "keep"), (2, "z", "update"), (3, None, "insert")}
    assert {(r.k, r.action) for r in catalog.diff(a, b, "k", ["v"]).collect()} == {(1, "delete"), (2, "update"), (3, "insert")}


def test_stale_progress_is_no_op(spark):
    df = spark.createDataFrame([("cataloging", "uploading"), ("queued", "processing"), ("accepted", "uploading")], "current string, wanted string")
    assert {(r.current, r.verdict) for r in catalog.check_transitions(df).collect()} == {("cataloging", "no_op"), ("queued", "applied"), ("accepted", "rejected")}


def test_global_index(spark):
    df = spark.createDataFrame([(i,) for i in random.Random(4).sample(range(1000), 300)], "x int").repartition(5)
    got = ordering.with_global_index(df, ["x"], "i").orderBy("x").collect()
    assert [r.i for r in got] == list(range(300))


def test_topk_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = random.Random(5)
    data = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(150)] + [(150, None), (151, [0.0] * 8)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {}
    for r in vectors.cosine_topk(df, df.where("vec_id % 20 = 0"), 3).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = r.vec_id
    import numpy as np

    x = np.array([v for _, v in data[:150]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for q in range(0, 150, 20):
        s = x @ x[q]
        s[q] = -9
        assert [got[q][k] for k in (1, 2, 3)] == list(np.argsort(-s)[:3])


def test_html():
    h = "<h2>A &amp; B</h2><p>one <b>two</b> <a href='u'>l</a></p><ul><li>x</li><li>y</li></ul><script>no</script>"
    assert text.html_to_text_of(h) == "A & B one two l x y"
    md = text.html_to_markdown_of("<h2>A</h2><p>one <b>two</b></p><ul><li>x</li></ul><p>E=mc<sup>2</sup></p>")
    assert md == "## A\n\none **two**\n\n- x\n\nE=mc<sup>2</sup>"


def test_keywords_and_doi(spark):
    df = spark.createDataFrame([("Keywords: a b, c., ,d", "see 10.1234/ABC.5."), (None, None)], "k string, d string")
    r = df.select(text.keywords(F.col("k")).alias("k"), text.doi(F.col("d")).alias("d")).collect()
    assert r[0].k == ["a b", "c", "d"] and r[0].d == "10.1234/ABC.5" and r[1].d is None


def test_candidates_equal_overlaps_by_hand(spark):
    rng = random.Random(3)
    some = lambda: [float(x) for x in (rng.randint(0, 9), rng.randint(0, 9), rng.randint(5, 30), rng.randint(5, 30))]
    odd = [None, [], [1.0, 2.0], [1.0, 1.0, 0.0, 9.0], [-1.0, 0.0, 5.0, 5.0], [0.0, 0.0, float("inf"), 5.0], [0.0, 0.0, 5.0, float("nan")], [0.0, 0.0, 1001.0, 9.0], [3.0, 3.0, 3.0, 3.0], [0.0, 0.0, 0.0, 0.0]]
    items = [(k % 5, "p", f"i{k}", "title", rng.choice(odd) if k % 3 else some(), *rng.choice([(500.0, 500.0), (1000.0, 1000.0), (800.0, 400.0), (None, 400.0), (None, None)])) for k in range(120)]
    blocks_ = [(k % 5, "p", f"b{k}", "text", some() if k % 3 else rng.choice([None, [], [1.0, 2.0], [4.0, 4.0, 4.0, 4.0], [9.0, 9.0, 1.0, 1.0]])) for k in range(60)]
    want = {}
    for page, _, i, _, box, width, height in items:
        found = reconcile.box_candidates(box if box and len(box) == 4 else None, (width, height) if width and height else None)
        for other, _, b, _, where in blocks_:
            if other == page:
                space, iou = reconcile.overlap(found, where if where and len(where) == 4 else None)
                want[i, b] = (iou, {"page_units": 0, "normalized_0_1000": 1}.get(space))
    assert {space for _, space in want.values()} == {None, 0, 1}
    made = spark.createDataFrame(items, "record_id long, page string, id string, type string, bbox array<double>, width double, height double"), spark.createDataFrame(blocks_, "record_id long, page string, id string, type string, bbox array<double>")
    got = reconcile.candidates(*made).collect()
    assert {(r["item"], r.block): (r.iou, r.space) for r in got} == want and len(got) == len(want)
    assert got[0].__fields__ == ["record_id", "page", "item", "item_type", "block", "block_type", "iou", "space"]


def test_iou_pairs_shuffle_lines_once_and_join_numbers(spark, small):
    from foliate.plans import registry

    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = registry.QUERIES["iou_pairs"](spark, small)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    above, _, _ = plan.partition("SortMergeJoin")
    assert "ReusedExchange" in plan and "bbox" not in above and "boxes" not in above


def test_file_matches_by_hand(spark):
    files = [("f1", "abc"), ("f2", "Twice"), ("f3", "part-of"), ("f4", "many"), ("f5", "nowhere"), ("f6", ""), ("f7", "x" * 40), ("f8", "q"), ("f8", "abc")]
    targets = [("/1", "ABC", "abc.pdf"), ("/2", "twice", "twice.pdf"), ("/3", "twice", "twice.pdf"), ("/4", "a part-of it", "a Part-Of it.pdf"), ("/5", "many1", "many1.pdf"), ("/6", "many2", "many2.pdf"), ("/7", "y", "y" + "x" * 41 + ".pdf"), ("/7", "y", "y" + "x" * 41 + ".pdf")]
    got = {r.file: (r.outcome, r.n) for r in inventory.file_matches(spark.createDataFrame(files, "file string, name string"), spark.createDataFrame(targets, "path string, stem string, filename string")).collect()}
    assert got == {"f1": ("exact", 1), "f2": ("multiple_exact", 2), "f3": ("fuzzy", 1), "f4": ("multiple_fuzzy", 2), "f5": ("not_found", 0), "f6": ("not_found", 0), "f7": ("fuzzy", 1), "f8": ("exact", 1)}


def test_file_matches_equals_comparing_all(spark):
    rng = random.Random(7)
    word = lambda least, most: "".join(rng.choice("ab_") for _ in range(rng.randint(least, most)))
    stems = ["report_" + word(1, 60) for _ in range(60)]
    targets = [(f"/{k}", x, x.title() + ".pdf") for k, x in enumerate(stems)] + [(f"/twin{k}", x, "") for k, x in enumerate(stems[::2])] + [("/0", "twin", stems[1] + ".pdf"), (None, "none", "none.pdf"), ("/n", None, None)]
    cut = lambda x: x[(i := rng.randrange(len(x))) : i + rng.randint(1, 50)]
    files = [(f"f{k % 150}", rng.choice([cut(rng.choice(stems)), word(1, 12), rng.choice(stems).upper() if k % 9 == 0 else "report_", cut(rng.choice(stems)) + "é"])) for k in range(250)] + [("f0", None), ("g", ""), ("h", "none")]
    want = {}
    for f in {f for f, _ in files}:
        names = {n.lower() for g, n in files if g == f and n}
        exact, fuzzy = ({p for p, *x in targets if p and x[side] and any(hit(x[side].lower(), n) for n in names)} for side, hit in ((0, str.__eq__), (1, str.__contains__)))
        n = len(exact or fuzzy)
        want[f] = ("not_found", 0) if not n else (("multiple_" if n > 1 else "") + ("exact" if exact else "fuzzy"), n)
    assert {o for o, _ in want.values()} == {"exact", "multiple_exact", "fuzzy", "multiple_fuzzy", "not_found"}
    got = inventory.file_matches(spark.createDataFrame(files, "file string, name string"), spark.createDataFrame(targets, "path string, stem string, filename string")).collect()
    assert {r.file: (r.outcome, r.n) for r in got} == want and len(got) == len(want)


def test_file_matches_broadcast_window_lengths_only(spark, small):
    from foliate.plans import registry

    df = registry.QUERIES["file_matching"](spark, small)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    assert plan.toString().partition("Initial Plan")[2].count("BroadcastExchange") <= 2  # of one column, read by the pieces and by their counts
    assert "BroadcastNestedLoopJoin" not in plan.toString() and "CartesianProduct" not in plan.toString()


def test_newest_first_keeps_every_record(spark):
    rows = [("a", t) for t in range(7)] + [("b", 1)]
    got = catalog.newest_first(spark.createDataFrame(rows, "k string, t int"), "k", ["t"]).collect()
    assert sorted((r.k, r.t, r["rank"]) for r in got) == sorted([("a", t, 7 - t) for t in range(7)] + [("b", 1, 1)])


def test_contextual_blocks_of_every_role(spark):
    rows = [(f"b{k}", "d", k, role, text) for k, (role, text) in enumerate([("body", "before"), ("title", "Paper"), ("abstract", "short"), ("title", "1. Part"), ("body", "long"), ("list", " x\n"), ("reference", None)])] + [("e0", "e", 0, "metadata", "alone")]
    blocks = spark.createDataFrame(rows, "block_id string, document_id string, reading_order int, role string, text string").withColumn("loaded_at", F.current_timestamp())
    titles = spark.createDataFrame([("d", "Name"), ("e", " ")], "document_id string, title string")
    got = {r.block_id: r.contextual for r in extras.contextual_blocks(blocks, titles).collect()}
    head, part = "Documento: Name", "Documento: Name\nSeção: Paper > 1. Part"
    assert got == {"b0": f"{head}\n\nbefore", "b1": f"{head}\nSeção: Paper\n\nPaper", "b2": f"{head}\nSeção: Paper\n\nshort", "b3": f"{part}\n\n1. Part", "b4": f"{part}\n\nlong", "b5": f"{part}\n\n x", "e0": "alone"}


# ---- audits and state -----------------------------------------------------------------------


def test_inspection_codes():
    codes = lambda p, pages=None: audit.inspect(p, pages)[-2:]
    block = {"type": "text", "lines": [{"spans": [{"type": "text", "text": "x" * 1100}]}]}
    assert codes(None) == codes("{") == ("invalid_json", "") and codes("[1]") == ("invalid_root", "")
    assert codes('{"a": 1}') == ("pages_not_found", "")
    assert codes(json.dumps({"pages": [{"para_blocks": [block]}]}), 1) == ("", "")
    assert codes(json.dumps({"pages": [{"para_blocks": [block]}]}), 2) == ("page_count_mismatch", "")
    assert codes('{"pages": []}')[0] == "zero_pages,no_blocks,no_text_or_assets"
    assert codes('{"pages": [{"para_blocks": 7}]}')[0] == "invalid_para_blocks,no_blocks,no_text_or_assets"
    assert codes('{"pages": [{"para_blocks": [{"type": "text", "lines": 3}]}]}')[0] == "invalid_block_structure,no_text_or_assets"
    assert codes('{"pages": [{"para_blocks": [{"type": "image"}]}]}') == ("", "no_text_with_assets,high_textless_page_ratio,small_middle_json")
    odd = {"pages": [{"para_blocks": [{**block, "type": "index"}, {"type": "text", "lines": [{"spans": [{"type": "sup"}]}]}]}]}
    assert codes(json.dumps(odd)) == ("", "unknown_block_types,unknown_span_types")


def test_trees_lose_nothing(spark):
    p = json.dumps({"pages": [{"para_blocks": [{"blocks": [{"lines": [{"spans": [{}, 3]}]}], "lines": {}}, 7], "discarded_blocks": {}, "preproc_blocks": [{}]}]})
    df = spark.createDataFrame([(1, "d", "s", p, None), (2, None, None, None, None), (3, "d", "s", "{", None)], "record_id long, document_id string, source_name string, payload string, received_at timestamp")
    (r,) = audit.tree_validation(df).collect()
    assert (r.record_id, r.pages, r.blocks, r.discarded, r.nested, r.nodes, r.lines, r.spans, r.failed) == (1, 1, 1, 1, 1, 3, 2, 1, "")
    m = audit.document_metrics(df).first()
    assert (m.pages, m.content_blocks, m.discarded_blocks, m.lines, m.spans) == (1, 2, 1, 2, 1)
    assert audit.tree_validation(df.limit(0)).count() == audit.document_metrics(df.limit(0)).count() == 0


def test_four_texts_of_a_block():
    b = {"text": "T", "content": "C", "html": "<b>H</b>", "latex": "L", "blocks": [{"type": "text", "content": "child"}, {"type": "image", "content": "caption"}], "lines": [{"spans": [{"content": "sc", "text": "st"}, {"latex": "x"}]}]}
    assert [nested.block_text(b, v) for v in nested.VARIANTS] == ["T C st child caption", "T C <b>H</b> L st x child caption", "st[EQUAÇÃO]\n\nchild", "C"]
    assert nested.block_text({"lines": [{"spans": [{"text": "a"}, {"content": "b"}]}, {"spans": [{"image_path": "p"}]}]}, "chunk") == "ab\n[FIGURA]"


def test_runs_are_fenced():
    r = state.Run(10)
    steps = [
        (0, "a", None, "claim", "granted"), (1, "b", None, "claim", "held"), (2, "b", None, "processing", "stale"), (3, "a", 1, "processing", "applied"), (4, "a", 1, "processing", "no_op"), (5, "a", 1, "uploading", "applied"), (6, "a", 1, "processing", "no_op"), (7, "a", 1, "completed", "invalid"),
        (8, "a", 1, "heartbeat", "applied"), (30, "b", None, "claim", "granted"), (31, "a", 1, "cataloging", "stale"), (32, "b", 1, "cataloging", "stale"), (33, "b", 2, "cataloging", "applied"), (34, "b", 2, "completed", "applied"), (35, "b", 2, "completed", "no_op"), (36, "b", 2, "failed", "ended"), (37, "c", None, "claim", "ended"),
    ]
    assert [r.see(*s[:4]) for s in steps] == [s[4] for s in steps]


def test_person_names(spark):
    names = ["João da Silva", "A. Pagaquis", "Ana", "ANA SOUZA, Doutoranda em Economia", "Maria 2 Souza", "Revista Nova Era", "ana souza", "Universidade Federal", "Jean-Luc D'Arc", "x: Ana Souza", None, ""]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(bibliography.person_name(F.col("n"))).collect()]
    assert got == ["João da Silva", "A. Pagaquis", None, "ANA SOUZA", None, None, None, None, "Jean-Luc D'Arc", None, None, None]


def test_citations(spark):
    df = spark.createDataFrame([([], None), ([], "Inst"), (["A"], None), (["A", "B"], "Inst"), (["A", "B", "C"], None), (None, None)], "f array<string>, c string")
    assert [r[0] for r in df.select(text.citation_author(F.col("f"), F.col("c"))).collect()] == [None, "Inst", "A", "A e B", "A et al.", None]


def test_error_markers(spark):
    df = spark.createDataFrame([("meeting room",), ("device code expired",), ("Killed process 3",), ("CUDA OOM",), ("no CUDA-capable device is detected: out of memory",), ("HTTP 503",), ("HTTP 404",), (None,)], "m string")
    assert [r[0] for r in df.select(runs.error_class(F.col("m"))).collect()] == ["other", "other", "memory", "memory", "hardware", "retryable", "other", None]


def test_chunks_with_overlap():
    rng = random.Random(3)
    words = lambda t: len(t.split())
    for _ in range(60):
        t = "".join(f"w{i}" + "".join(rng.choice("abcdefghij") for _ in range(rng.choice([0, 30]))) + rng.choice([" ", ". ", "\n", "\n\n"]) for i in range(rng.randrange(0, 80)))
        for length in (len, words):
            made = chunking.split_with_overlap(t, 20, 5, length)
            assert all(length(c) <= 20 for c in made) and "".join(made).startswith(made[0] if made else "")
            at = 0
            for c in made:  # each chunk stands in the text, and none leaves a gap
                i = t.find(c)
                assert 0 <= i <= at < i + len(c)
                at = i + len(c)
            assert at == len(t)
    assert tokenizer.token_length("the the the") == 3
    assert all(tokenizer.token_length(c) <= 11 for c in chunking.split_with_overlap("the " * 50, 10, 3, tokenizer.token_length))


def test_markdown_of_payloads(spark):
    span = lambda k, t: {"type": k, "content": t}
    page = {
        "para_blocks": [{"type": "title", "level": 2, "lines": [{"spans": [span("text", "A "), span("inline_equation", "x")]}, {"spans": [span("text", "B")]}]}, {"type": "image", "image_path": "img/a.png", "blocks": [{"type": "text", "lines": [{"spans": [span("text", "caption")]}]}]}, {"type": "table", "html": "<table><tr><td>1</td></tr></table>"}, {"type": "page_number", "content": "7"}],
        "discarded_blocks": [{"type": "footer", "content": "foot"}, {"type": "header", "content": "head"}, {"type": "page_number", "content": "8"}],
    }
    text_, images = render.tree_markdown({"pages": [page]})
    assert text_ == "head\n\n## A $x$<br>\nB\n\n![](<img/a.png>)\n\ncaption\n\n| 1 |\n| --- |\n\nfoot\n" and images == ["img/a.png"]
    assert render.tree_markdown({"para_blocks": [{"content": "plain"}]})[0] == "# plain\n" and render.tree_markdown({"pages": []}) == ("", [])
    p = json.dumps({"pages": [page]})
    rows = [(1, "d", p, "2024-01-01 00:00:00"), (2, "e", p, "2024-01-01 00:00:00"), (3, "d", "{", "2024-01-01 00:00:55"), (4, "d", "{", "2024-01-01 00:00:30"), (5, "d", None, "2024-01-01 00:00:00"), (6, "d", "{}", "2024-01-01 00:00:00")]
    df = spark.createDataFrame(rows, "record_id long, document_id string, payload string, t string").withColumn("received_at", F.col("t").cast("timestamp_ntz"))
    assets = spark.createDataFrame([("d", "store/a.png")], "document_id string, path string")
    got = {r.record_id: (r.render_status, r.missing) for r in render.payload_markdown(df, assets.selectExpr("document_id", "substring_index(path, '/', -1) as path"), "2024-01-01 00:01:00").collect()}
    assert got == {1: ("ok", 0), 2: ("incomplete", 1), 3: ("pending", 0), 4: ("failed", 0), 5: ("pending", 0), 6: ("skipped", 0)}


def test_streamed_breaker_equals_the_batch(spark, small):
    from foliate.plans import registry

    got, want = (sorted(map(tuple, registry.QUERIES[q](spark, small).collect())) for q in ("stream_breaker", "circuit_breaker"))
    assert got == want and {s for _, _, s in want} >= {"open", "half_open"}
