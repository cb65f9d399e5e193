"""The llm operators against brute force, exact round trips and hand-made cases, with nulls, empty and very long texts, repeats and empty tables."""

import itertools
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliate.llm import boosting, leakage, lookalike, ocr, packing, quantiles, queries, sitelines, spam, splitting, tokens

from ..helpers import from_spark, from_sql

BLOCK = "block_id string, document_id string, collection_slug string, page int, reading_order int, section_id string, role string, source_type string, text string, extra int, line_no int, h1 long"


def blocks(spark, rows):
    """``(block_id, document_id, slug, page, order, role, text)``, with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(b, d, s, p, o, f"{d}:s" if d else None, r, "text", t, 7, 1, 2) for b, d, s, p, o, r, t in rows], BLOCK)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, small, name):
    assert from_spark(queries.QUERIES[name](spark, small)) == from_sql(queries.SQL[name], small)


# ---- 1: site lines --------------------------------------------------------------------------


def site_lines_by_hand(rows, min_documents=3, share=0.04):
    docs, seen, at = defaultdict(set), defaultdict(set), defaultdict(set)
    for b, d, s, _, _, r, t in rows:
        docs[s].add(d)
        if r == "title" or t is None:
            continue
        for k, line in enumerate(t.split("\n")):
            key = "".join(c for c in lookalike.fold(line).lower() if c.isalpha())
            if len(key) >= 15:
                seen[s, key].add(d)
                at[s, key].add((b, k))
    return {x for (s, key), ds in seen.items() if len(ds) >= min_documents and len(ds) >= share * len(docs[s]) for x in at[s, key]}


@pytest.mark.parametrize("hot, few", [(10**6, 10**6), (7, 0)])
def test_site_lines(spark, monkeypatch, hot, few):
    """Also with salted lines and without broadcasts."""
    monkeypatch.setattr(sitelines, "SALT_ROWS", hot)
    monkeypatch.setattr(sitelines, "BROADCAST_NODES", few)
    rng = random.Random(1)
    site = ["All rights reserved by Siteum, 2019.", "Subscribe to the Siteum bulletin", "Short line"]
    rows = []
    for i in range(160):
        slug = "hot" if i % 3 else None
        lines = [f"sentence number {chr(97 + i % 26) * 16} {chr(97 + i // 26) * 9} of its own" for _ in range(2)]
        if rng.random() < 0.3:
            lines.insert(rng.randrange(2), rng.choice([site[0], site[0].upper().replace("2019", "77"), site[0].replace("a", "а"), "  ﻿" + site[0] + " *"]))
        if i < 5:
            lines.append(site[1])
        if i % 7 == 0:
            lines.append(site[2])
        rows.append((f"b{i}", f"d{i // 2}", slug, 0, i, rng.choice(["body", "other", None, "title"]), "\n".join(lines)))
    rows += [rows[3], ("n", "d1", "hot", 0, 0, "body", None), ("e", "d1", "hot", 0, 0, "body", ""), ("l", "d1", "hot", 0, 0, "body", "x y " * 200_000)]
    got = {tuple(r) for r in sitelines.found(blocks(spark, rows)).collect()}
    assert got == site_lines_by_hand(rows) and got
    clean = {r.block_id: r for r in sitelines.without_site_lines(blocks(spark, rows)).collect()}
    assert clean["n"].text is None and clean["e"].text == ""
    for b, d, s, _, _, r, t in rows:
        if t:
            assert clean[b].text == "\n".join(x for k, x in enumerate(t.split("\n")) if (b, k) not in got)
    assert sitelines.found(blocks(spark, [])).count() == 0


def test_consecutive_site_lines_are_one_component(spark):
    rows = [(f"b{i}", f"d{i}", "s", 0, 0, "body", f"own words of document {chr(97 + i) * 9}\nFirst line of the notice\nSecond line of the notice\n\nAnother line that repeats") for i in range(6)]
    parts = sitelines.site_line_occurrences(blocks(spark, rows)).select("line_no", "component").distinct().collect()
    by = {r.line_no: r.component for r in parts}
    assert set(by) == {1, 2, 4} and by[1] == by[2] != by[4]


# ---- 2: packing -----------------------------------------------------------------------------


def test_packing_keeps_the_rules():
    rng = random.Random(2)
    for _ in range(200):
        capacity = rng.randrange(5, 60)
        items = sorted(((rng.randrange(1, 40), rng.randrange(3), rng.randrange(6)) for _ in range(rng.randrange(0, 40))), reverse=True)
        bins = defaultdict(list)
        for item, b in zip(items, packing.pack(items, capacity, separator=1)):
            bins[b].append(item)
        for held in bins.values():
            assert len({c for *_, c in held}) == len(held)
            assert sum(n for n, *_ in held) + len(held) - 1 <= capacity or len(held) == 1


def test_packing_takes_the_tightest_bin_without_conflict():
    # residuals 4, 6 and 5 after the first three; the last fits best into the first, but is a copy of its item
    assert packing.pack([(6, 0, 0), (5, 0, 2), (4, 0, 1), (4, 0, 0)], 10, separator=0) == [0, 1, 0, 1]


def test_packing_is_near_the_least(spark):
    rng = random.Random(3)
    items = sorted(((rng.randrange(1, 300), 0, i) for i in range(2000)), reverse=True)
    used = max(packing.pack(items, 1000, separator=0)) + 1
    assert used <= 1.01 * sum(n for n, *_ in items) / 1000 + 1


def test_parts_cost_few_chunks(spark):
    """A hot section in parts of 2,000 needs hardly more chunks than in one piece."""
    rng = random.Random(33)
    rows = [(f"b{i}", "d", "s", 0, i, "body", "x" * int(20 + 600 * rng.random() ** 2) + str(i)) for i in range(20_000)]
    df, policies = blocks(spark, rows), spark.createDataFrame([("s", 1200, 0)], "collection_slug string, chunk_size int, chunk_overlap int")
    whole, parts = (packing.pack_sections(df, policies, part=n).select("chunk_id").distinct().count() for n in (10**9, 2_000))
    assert whole <= parts <= 1.003 * whole, (whole, parts)


def test_sources_and_copies_conflict():
    assert packing.pack([(3, 0, None), (3, 1, None), (3, 0, None)], 100, max_sources=1) == [0, 1, 0]
    assert packing.pack([(3, 0, 5), (3, 0, 5), (3, 0, None)], 100) == [0, 1, 0]


def test_pack_sections(spark):
    policies = spark.createDataFrame([("s", 100, 10)], "collection_slug string, chunk_size int, chunk_overlap int")
    rows = [(f"b{i}", "d", "s", 0, i, "body", chr(97 + i % 26) * (1 + i % 90)) for i in range(180)] + [("big", "d", "s", 0, 0, "body", "x" * 101), ("nil", "d", "s", 0, 0, "body", None), ("emp", "d", "s", 0, 0, "body", ""), ("nod", None, None, 0, 0, "body", "abc")]
    rows.append(rows[5])
    got = packing.pack_sections(blocks(spark, rows), policies, part=50).collect()
    assert sorted(r.block_id for r in got) == sorted({r[0] for r in rows} - {"nil", "emp"})
    sums = defaultdict(list)
    for r in got:
        sums[r.chunk_id].append(r.length)
    assert all(sum(x) + len(x) - 1 <= 100 or x == [101] for x in sums.values())
    assert packing.pack_sections(blocks(spark, []), policies).count() == 0


# ---- 3: look-alikes -------------------------------------------------------------------------


def test_stable_characters_never_change():
    odd = re.compile(lookalike.UNSTABLE)
    assert all(odd.search(chr(c)) for c in lookalike.mapping())
    for t in ("ação", "Straße – 5‰ «x»", "x²", "Tschüß, naïve café", "(β)"):
        assert lookalike.fold(t) == t


def test_fold():
    for a, b in (("Ｆｕｌｌ　ｗｉｄｔｈ", "Full width"), ("ação", "ação"), ("w​o­rd﻿", "word"), ("а сор", "a cop"), ("ﬁﬂow", "fiflow"), ("non‑breaking", "non-breaking"), ("ё", "ë"), ("Τοɡ", "Tog")):
        assert lookalike.fold(a) == b == lookalike.fold(b)
    assert len({lookalike.fold(t) for t in ("a", "A", "á", "a?", "x2", "x²", "a-b", "a–b")}) == 8


def test_column_equals_fold(spark):
    rng = random.Random(4)
    alphabet = "abcé ñА̧́​ ｘﬁ–²𝒳\U0001f600\n"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 30))) for _ in range(400)] + [None, "", "​", "ｘ" * 50_000, "ȩ̣́"]
    df = spark.createDataFrame([(i, t, "c") for i, t in enumerate(texts)] + [(0, texts[0], "d")], "id int, t string, unified string")
    got = lookalike.unify_column(df, "t")
    assert got.columns == ["id", "t", "unified"]
    for r in got.collect():
        assert r.unified == (None if r.t is None else lookalike.fold(r.t))


def test_pairs_against_brute_force(spark):
    rng = random.Random(5)
    base = ["title one", "tïtle two", "", "three"]
    rows = []
    for i in range(120):
        t = rng.choice(base)
        if rng.random() < 0.4 and t:
            t = t.replace("t", rng.choice(["ｔ", "t​", "Τ".lower() and "t"]), 1)
        rows.append(("title" if i % 2 else "text", f"k{i:03d}", t))
    rows += [rows[0], ("title", None, "title one"), ("title", "k999", None), ("title", "k001", "title one")]
    want = set()
    for a, b in itertools.permutations({r for r in rows if None not in r}, 2):
        if a[0] == b[0] and a[1] < b[1] and a[2] != b[2] and lookalike.fold(a[2]) == lookalike.fold(b[2]):
            want.add((a[0], a[1], b[1]))
    df = spark.createDataFrame(rows, "field string, key string, t string")
    got = [tuple(r) for r in lookalike.look_alike_pairs(df, "field", "key", "t").collect()]
    assert set(got) == want and len(got) == len(want) and want
    assert lookalike.look_alike_pairs(df.limit(0), "field", "key", "t").count() == 0


# ---- 4: percentiles -------------------------------------------------------------------------


def ranks_hold(values, estimate, q, error):
    v = np.sort(values)
    rank = max(1, int(np.ceil(q * len(v))))
    width = abs(estimate) * 2.0**-19
    return np.searchsorted(v, estimate - width, "left") - error < rank <= np.searchsorted(v, estimate + width, "right") + error


def test_percentiles_merged_in_any_grouping(spark):
    rng = np.random.default_rng(6)
    xs = np.concatenate([rng.lognormal(3, 2, 20_000), -rng.lognormal(1, 1, 2_000), np.zeros(500), [1e12, -1e12]])
    df = spark.createDataFrame([(i % 7, "m", float(x)) for i, x in enumerate(xs)], "part int, metric string, x double")
    parts = quantiles.summaries(df, ["metric", "part"], 0.05)
    for summary in (quantiles.merge(parts, ["metric"], 0.05), quantiles.summaries(df, ["metric"], 0.05)):
        assert summary.agg(F.sum("c")).first()[0] == len(xs)
        rows = quantiles.percentiles(summary, ["metric"], epsilon=0.05).collect()
        assert len(rows) == len(quantiles.PERCENTILES)
        for r in rows:
            assert r.n == len(xs) and r.rank_error <= 0.05 * len(xs)
            assert ranks_hold(xs, r.value, r.q, r.rank_error), r
    nodes = quantiles.merge(parts, ["metric"], 0.05).count()
    assert nodes < 3 * quantiles.LEVELS / 0.05 + 2 ** (quantiles.LEVELS - quantiles.SUBTREE)


def test_leaf_is_monotone_and_inverted(spark):
    xs = sorted([0.0, 1e-30, -1e-30, 1.0, 1.5, 2.0, 1.9999999, -2.0, 3.25, 1e300, -1e300, 2.0**40, 0.1, -0.1])
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", quantiles.leaf(F.col("x")).alias("l")).withColumn("v", quantiles.value(F.col("l"))).orderBy("x").collect()
    assert [r.l for r in rows] == sorted(r.l for r in rows)
    for r in rows:
        if 1e-10 < abs(r.x) < 1e15:
            assert abs(r.v - r.x) <= abs(r.x) * 2.0**-20


def test_dirty_runs(spark):
    cols = "pod_number int, started_at string, duration_seconds double, seconds_per_page double"
    rows = [(1, "2025-01-01T00:00:00Z", 5.0, None), (1, "2025-01-01T00:00:00Z", 5.0, None), (1, "x", 7.0, float("nan")), (None, None, -3.0, float("inf")), (2, None, None, None)]
    df = spark.createDataFrame(rows, cols)
    got = {(r.pod_number, r.metric, r.q): (round(r.value, 4), r.n) for r in quantiles.pod_percentiles(df).collect()}
    assert got[1, "duration_seconds", 0.5] == (5.0, 2) and got[None, "duration_seconds", 0.99] == (-3.0, 1)
    assert all(m == "duration_seconds" and p != 2 for p, m, _ in got)
    assert quantiles.pod_percentiles(df.limit(0)).count() == 0


# ---- 5: scan noise --------------------------------------------------------------------------


def speller():
    words = "the operator of network reveals contract disputes and before after settlement agency border margin transmission tariff residual claim renewable output whenever reserves fall short pattern imports payment".split()
    return ocr.Speller({w: 500 for w in words}).train(["bananov", "limivobra", "zokareth", "tresodofe"])


def test_misread_words():
    s = speller()
    for token, right in (("pattcrn", "pattern"), ("transmissi0n", "transmission"), ("borcler", "border"), ("residiial", "residual"), ("t^ariff", "tariff"), ("Payme|nt,", "payment"), ("outp@ut", "output"), ("irnports.", "imports")):
        assert s.correct(token) == right, token
    for token in ("pattern", "Limivobra", "(Bananov,", "1998).", "https://a.example/x0y", "A-221", "contract-disputes", "§", "", "pre-", "5%"):
        assert s.correct(token) is None, token


def test_held_out_corruptions():
    """Most one-letter corruptions not seen in training are set right, and clean words stay."""
    s = speller()
    rng = random.Random(9)
    good = bad = 0
    for _ in range(300):
        w = rng.choice([w for w in s.words if len(w) > 5])
        i = rng.randrange(1, len(w) - 1)
        bad += 1
        good += s.correct(w[:i] + rng.choice("^~*|") + w[i:]) == w
    assert good >= 0.9 * bad
    assert all(s.correct(w) is None for w in s.words)


def test_confusions_keep_the_skeleton():
    for seen, true in ocr.CONFUSIONS:
        assert ocr.skeleton(f"a{seen}o") == ocr.skeleton(f"a{true}o"), (seen, true)


def test_every_candidate_above_the_threshold_is_ranked():
    """The true word is no longer cut when three others share more q-grams with what was read."""
    s = ocr.Speller({w: 500 for w in ("margin", "margem", "margen", "marge", "margins", "marginal", "inverno", "invento", "invest", "investe", "ordem", "ordena", "orders", "order")})
    for seen, true in (("margein", "margem"), ("invemo", "inverno"), ("ordern", "ordem")):
        assert s.correct(seen) == true, seen


def test_words_below_the_share_are_candidates(spark, monkeypatch):
    """A word seen too rarely for the broadcast vocabulary is found where it is misread, and is sound itself."""
    rows = [(f"f{k}", "d", "s", 0, k, "body", "the operator of the network reveals the margin " * 20) for k in range(50)]
    rows += [(f"r{k}", "d", "s", 0, 100 + k, "body", "the quadrangle of the network") for k in range(60)]
    rows += [("x", "d", "s", 0, 200, "body", "the quadranglc of the network."), ("y", "d", "s", 0, 201, "body", "the Quadranglc of the nctwork.")]
    df = blocks(spark, rows)
    monkeypatch.setattr(ocr, "VOCABULARY_SHARE", 0.02)
    speller, _ = ocr.fit_speller(df)
    assert speller.rarer and "quadrangle" not in speller.vocabulary
    assert {r.block_id for r in ocr.found(df).where("noise = 'misread'").collect()} == {"x", "y"}
    assert "the quadrangle of the network." in " ".join(r.text for r in ocr.paragraphs(df).collect())


def test_broken_words():
    v = speller().joiner
    for text, n in (("the con-\ntract", 1), ("the con- \r\n tract", 1), ("con­\ntract", 1), ("con¬\ntract", 1), ("the con- tract", 1), ("short- and long-term", 0), ("well-known", 0), ("the con­tract", 0), ("ends in con-", 1), ("a - b", 0), ("Zoka-\nreth", 1)):
        assert len(ocr.broken_words(text, "", v)) == n, text


def test_runs_give_what_the_whole_document_gives(spark, small, monkeypatch):
    """Noise and paragraphs do not depend on where a document is cut: headers, page numbers and broken words reach across runs."""
    df = spark.read.parquet(f"{small}/block_units.parquet")
    found = lambda: sorted(map(tuple, ocr.found(df).collect()))
    parts = lambda: sorted((r.document_id, r.text) for r in ocr.paragraphs(df).collect())
    whole = found(), parts()
    assert {k for _, k in whole[0]} == {"hyphenation", "misread", "running_header", "page_number"}
    monkeypatch.setattr(ocr, "RUN", 7)
    assert (found(), parts()) == whole
    monkeypatch.setattr(ocr, "LONG_BROADCAST", 0)
    assert found() == whole[0]


def test_cost_of_long_words():
    """The band changes nothing within the limit, and long words are compared like short ones."""
    a = "".join("abcdefghij"[k % 10] for k in range(60))
    assert abs(ocr.confusion_cost(a.replace("c", "e"), a) - 1.8) < 1e-9 and ocr.confusion_cost("x" * 40, "y" * 40) == 3.5
    assert abs(ocr.confusion_cost(a[:30].replace("c", "e") + a[30:], a) - 0.9) < 1e-9


def test_document_noise(spark):
    rows = [("t", 0, "title", "Network rules: evidence from the Limivobra basin"), ("a", 0, "metadata", "Zokareth; Bananov")]
    for p in range(3):
        rows += [(f"h{p}", p, "other", f"{10 + p}   Network rules, Limivobra"), (f"x{p}", p, "body", f"the operator reveals\nthe margin\n- {10 + p} -"), (f"n{p}", p, "body", "ZOKARETH e BANANOV\nthe agency of the border" if p else "the agency")]
    rows += [("tab", 1, "table", "11\n12\n13"), ("y", 1, "body", "(Bananov,\n1998).")]
    got = defaultdict(set)
    for b, k in ocr.Document(rows, speller()).noise():
        got[b].add(k)
    assert got == {"h0": {"running_header"}, "h1": {"running_header"}, "h2": {"running_header"}, "x0": {"page_number"}, "x1": {"page_number"}, "x2": {"page_number"}, "n1": {"running_header"}, "n2": {"running_header"}}


def test_paragraphs_go_on_across_pages():
    rows = [("a", 0, "body", "the oper-\nator of the netw0rk reveals con-"), ("n", 0, "other", "- 7 -"), ("b", 1, "body", "- 8 -\ntract disputes and the margin.")]
    assert list(ocr.Document(rows, speller()).paragraphs()) == ["the operator of the network reveals contract disputes and the margin."]


def test_noise_of_dirty_tables(spark):
    rows = [("a", "d", "s", None, None, "body", None), ("b", None, None, None, None, None, ""), ("c", "d", "s", 0, 1, "body", "word " * 50_000), ("c", "d", "s", 0, 1, "body", "word " * 50_000)]
    assert ocr.found(blocks(spark, rows)).count() == 0
    assert ocr.found(blocks(spark, [])).count() == 0


def test_boosting_learns():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(2000, 3))
    y = ((x[:, 0] > 0) & (x[:, 1] > 0.3)).astype(float)
    model = boosting.Boosted().fit(x[:1000], y[:1000])
    right = sum((model.score(tuple(r)) > 0) == bool(t) for r, t in zip(x[1000:], y[1000:]))
    assert right > 950


# ---- 7: splitting ---------------------------------------------------------------------------


def test_pieces_cover_the_text_within_the_size():
    rng = random.Random(8)
    for _ in range(400):
        t = "".join(rng.choice(["word", " ", ". ", "\n", "\n\n", ", ", "x" * rng.randrange(1, 60)]) for _ in range(rng.randrange(0, 150)))
        size, overlap = rng.randrange(1, 200), rng.randrange(0, 120)
        made = splitting.split(t, size, overlap)
        assert made[0][0] == 0 and made[-1][1] == len(t)
        assert all(b - a <= size for a, b in made)
        assert all(a2 > a1 and a2 <= b1 for (a1, b1), (a2, _) in zip(made, made[1:]))
        if len(t) <= size:
            assert made == [(0, len(t))]


def test_pieces_are_added_until_the_limits_hold():
    """Texts in which one long run follows another make many attempts fail; the bound on their number is that of adding a piece at each failure."""
    rng = random.Random(88)
    for _ in range(60):
        t = "".join("x" * rng.randrange(60, 100) + rng.choice("\n ") for _ in range(300))
        at, strength = splitting.boundaries(t)
        grown = splitting._attempt(len(t), 100, 30, 2, at, strength, 0.05, grow=True)
        made = splitting.split(t, 100, 30)
        assert len(made) <= len(grown)
        for ranges in (made, grown):
            assert all(b - a <= 100 for a, b in ranges) and ranges[-1][1] == len(t)
            assert all(a < a2 <= b for (a, b), (a2, _) in zip(ranges, ranges[1:]))


def test_pieces_end_at_sentences_and_share_the_overlap():
    t = "".join(f"Sentence number {i:04d} has a few words of its own. " for i in range(400))
    made = splitting.split(t, 1200, 100)
    assert all(t[:b].rstrip().endswith(".") for _, b in made[:-1])
    assert len(made) <= -(-len(t) // 1000) + 1
    shared = [b1 - a2 for (_, b1), (a2, _) in zip(made, made[1:])]
    assert all(80 <= s <= 120 for s in shared)
    lengths = [b - a for a, b in made]
    assert max(lengths) - min(lengths) < 400
    with pytest.raises(ValueError):
        splitting.split("ab", 0, 0)


def test_split_blocks(spark):
    policies = spark.createDataFrame([("s", 10, 3)], "collection_slug string, chunk_size int, chunk_overlap int")
    rows = [("a", "d", "s", 0, 0, "body", "é" * 10), ("b", "d", "s", 0, 0, "body", "é" * 11), ("b", "d", "s", 0, 0, "body", "é" * 11), ("c", "d", "other", 0, 0, "body", "z" * 99), ("n", "d", "s", 0, 0, "body", None), ("m", "d", None, 0, 0, "body", "q" * 30), ("l", "d", "s", 0, 0, "body", "ab " * 100_000)]
    assert sorted(r.block_id for r in splitting.found(blocks(spark, rows), policies).collect()) == ["b", "l"]
    whole = splitting.split_blocks(blocks(spark, rows), policies).collect()
    assert {r.block_id for r in whole} == {"a", "b", "c", "m", "l"} and all(len(r.text) <= 10 for r in whole if r.block_id in "abl")


# ---- 8: tokens ------------------------------------------------------------------------------


def test_ids_equal_the_library_and_decode_to_the_text(spark, monkeypatch):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(f"{tokens.tokenizer_folder()}/{tokens.VOCABULARY}.json")
    library.encode_special_tokens = True
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 300)
    rng = random.Random(10)
    alphabet = "ab  \n\t'sé1½ 　中\U0001f600.,\x1c\x85-"
    texts = [None, "", " ", "<|endoftext|> x", "it's we'll", "x" * 5000] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 80))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, "c", [1]) for i, t in enumerate(texts)], "doc_id long, text string, block string, ids array<int>")
    encoded = tokens.encode_corpus(df)
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert got == {i: library.encode(t, add_special_tokens=False).ids if t else [] for i, t in enumerate(texts)}
    assert {r.doc_id: r.text for r in tokens.decode_corpus(encoded).collect()} == {i: t or "" for i, t in enumerate(texts)}
    assert tokens.encode_corpus(df.limit(0)).count() == 0
    # the salts of frequent words change nothing
    monkeypatch.setattr(tokens, "SALT_BLOCKS", 2)
    assert {r.doc_id: r.ids for r in tokens.encode_corpus(df).collect()} == got


def test_ids_of_null_and_repeated_documents(spark, monkeypatch):
    """Long rows of one id and equal numbers of words make blocks of their own and keep their own words."""
    monkeypatch.setattr(tokens, "BLOCK_CHARS", 10)
    rows = [(1, "alpha beta gamma"), (1, "delta omega sigma"), (None, "alpha beta"), (None, None), (None, "")]
    got = tokens.encode_corpus(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.ids) for r in got) == sorted((i or 0, ids_of(t)) for i, t in rows)


def ids_of(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(f"{tokens.tokenizer_folder()}/{tokens.VOCABULARY}.json").encode(text, add_special_tokens=False).ids if text else []


# ---- 9: leakage -----------------------------------------------------------------------------


def leaks_by_hand(docs, items, n):
    return {(d, k) for d, t in docs if t for k, x in items if x for w in [leakage.words(x)] for v in [leakage.words(t)] if {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} & {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}}


def test_leaks_against_brute_force(spark):
    rng = random.Random(11)
    word = lambda: rng.choice("abcd")
    for n in (3, 5):
        items = [(k, " ".join(word() for _ in range(rng.randrange(0, 14)))) for k in range(25)] + [(99, None), (98, "")]
        docs = [(i, " ".join(rng.choice(["a", "b", "c", "d", "**A**", "B,", "ｃ", "x"]) for _ in range(rng.randrange(0, 30)))) for i in range(60)] + [(900, None), (901, ""), (902, "zz " * 50_000)]
        dd = spark.createDataFrame([(i, t, 1) for i, t in [*docs, docs[0]]], "doc_id long, text string, item_id long")
        ii = spark.createDataFrame([*items, items[0]], "item_id long, text string")
        got = {(r.doc_id, r.item_id) for r in leakage.leaks(dd, ii, n).collect()}
        assert got == leaks_by_hand(docs, items, n) and got
    assert leakage.found(dd, ii.limit(0)).count() == 0


def test_leaked_spans_are_cut():
    auto = leakage.SuffixAutomaton([("i", leakage.words("one two three four five"))], 3)
    t = "Keep this. One, **two** three\nfour! Keep that."
    spans = leakage.spans_of(auto.matches(leakage.words(t)))
    assert spans == [(2, 6)] and leakage.cut_words(t, spans).split() == ["Keep", "this.", "!", "Keep", "that."]


def test_several_automata_give_what_one_gives(spark, monkeypatch):
    """One clean text a document, without the passages of any item, whatever the number of automata."""
    items = [(k, " ".join(f"w{k}x{j}" for j in range(13))) for k in range(5)] + [(9, "w0x3 w0x4 " * 7)]
    text = dict(items)
    docs = [(k, f"pre {text[k]} post") for k in range(5)] + [(7, f"Own words of a page, {text[0]} and {text[3]}. {' '.join(f'own{i}' for i in range(60))}"), (8, text[1] + " " + text[2]), (10, "nothing here")]
    dd, ii = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    one = {tuple(r) for r in leakage.leaks(dd, ii).collect()}
    monkeypatch.setattr(leakage, "MAX_WORDS_AN_AUTOMATON", 20)
    several = [tuple(r) for r in leakage.leaks(dd, ii).collect()]
    assert set(several) == one and len(several) == len(one) == 9
    assert {r[0]: r[5] for r in several}[7].startswith("Own words of a page,  and . own0") and {r[0]: r[5] for r in several}[8] == ""


# ---- 10: spam -------------------------------------------------------------------------------


def cover_by_hand(s, least):
    n, out = len(s), [False] * len(s)
    for k in range(least, n):
        at = defaultdict(list)
        for i in range(n - k + 1):
            at[tuple(s[i : i + k])].append(i)
        for v in at.values():
            if len(v) > 1:
                for i in v:
                    out[i : i + k] = [True] * k
    return out


def test_repeated_cover_against_brute_force():
    rng = random.Random(12)
    for _ in range(500):
        s = "".join(rng.choice("abc") for _ in range(rng.randrange(0, 22)))
        for least in (2, 4):
            assert [bool(x) for x in spam.repeated_cover(s, least)] == cover_by_hand(s, least)


PROSE = "The operator of the network reveals the margin, while the agency restricts a claim that the border absorbs. In the long run, the tariff follows the output."


@pytest.mark.parametrize(
    "text, flagged",
    [
        ("cheap power bank, buy power bank, power bank sale, best power bank, buy term paper, cheap term paper, term paper sale", True),
        ("\n".join(f"- [buy term paper](https://shop.example/x{i})" for i in range(12)), True),
        ("\n".join(f"power bank Z-{i} | 9.{i} | tags: power bank, sale, power bank" for i in range(8)), True),
        ("#BuyPowerBank #CheapPowerBank #BuyPowerBank #CheapPowerBank #BuyPowerBank #CheapPowerBank #BuyPowerBank", True),
        (PROSE + "\n\ncheap power bank, buy power bank, power bank sale", False),
        (PROSE * 30, False),
        ("\n".join(f"Author{i}, A.; Other{i}, B. The margin of the network. Review of Power, {i}(2), 10–2{i}, 199{i}. https://doi.example/10.9999/{i}" for i in range(9)), False),
        ("\n".join(f"Place{i};199{i};6{i}.2;despite strict monitoring" for i in range(9)), False),
        ("\n".join("shoes boots sandals trainers".split() * 12), True),
        ("\n".join(f"solarinverter{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(100)), True),
        ("\n".join(f"solar inverter 20{i:02d}" for i in range(20)), True),
        ("\n".join(f"https://www.{w}.example/{w[::-1]}" for w in "quartz nimbus fjord blazon wyvern kettle".split()), True),
        ("", False),
        ("buy buy", False),
    ],
)
def test_spam(text, flagged):
    total, _, hits = spam.measure(text)
    assert (hits > spam.SPAM_SHARE * total) == flagged


def test_stopping_early_changes_nothing(spark, small):
    for r in spark.read.parquet(f"{small}/documents.parquet").where("text is not null").collect():
        a, b = spam.measure(r.text), spam.measure(r.text, stop_early=False)
        assert (a[2] > spam.SPAM_SHARE * a[0]) == (b[2] > spam.SPAM_SHARE * b[0])


def test_spam_of_dirty_tables(spark):
    bad = "cheap power bank, buy power bank, " * 20
    df = spark.createDataFrame([(1, bad, 0), (1, bad, 0), (2, None, 0), (3, "", 0), (4, " \n ", 0), (None, bad, 0), (5, "the a of " * 100_000, 0)], "doc_id long, text string, spam_words int")
    assert [r.doc_id for r in spam.found(df).collect()] == [1]
    assert spam.found(df.limit(0)).count() == 0


