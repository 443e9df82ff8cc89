"""Operators 2, 5, 6, 7 and 9."""

import hashlib
import pathlib
import random
import re
import textwrap
import time
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from larkspur.llm import bagminhash, chat, common, fuzzylines, licenses, quality, urls


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (None, 3)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in common.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}}
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bitmap_lets_every_key_through(spark):
    keys = spark.range(0, 3000, 3).select("id").union(spark.createDataFrame([(None,)], "id long"))
    inside = common.maybe_in(common.bitmap_of(keys), F.col("id"))
    assert keys.where(inside).count() == keys.count()
    assert spark.range(10**6, 10**6 + 2000).where(inside).count() < 50
    assert spark.range(9).where(common.maybe_in(common.bitmap_of(keys.limit(0)), F.col("id"))).count() == 0


def test_without_treats_null_as_a_key(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "k long, t string")
    left = lambda gone: sorted(r.t for r in common.without(docs, spark.createDataFrame(gone, "g long"), "k").collect())
    assert left([(2,)]) == ["a", "c"] and left([(None,)]) == ["a", "b", "d"] and left([]) == ["a", "b", "c", "d"]


def test_exact_ties_stay_open(spark):
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    for k in (7, 14, 23, 28, 33, 1000):
        sizes = frame([(1, 9 * k, 0), (2, 4 * k, 4 * k), (3, 5 * k, 4 * k)], "id long, size long, shared long")
        rows, tested = frame([(5, 1), (5, 2), (5, 3)], "bucket long, id long"), frame([(2, 1, 0), (3, 1, 0)], "a long, b long, overlap long")
        got = common.open_pairs(rows, frame([], "node long, root long"), tested, 0.8, lambda ids: sizes)
        assert [tuple(r) for r in got.collect()] == [(3, 2)]
        less = sizes.withColumn("shared", F.when(F.col("id") == 3, 4 * k - 1).otherwise(F.col("shared")))
        assert common.open_pairs(rows, frame([], "node long, root long"), tested, 0.8, lambda ids: less).count() == 0


def test_members_that_the_stars_settle_are_not_open(spark):
    rows = spark.createDataFrame([(5, 1), (5, 2), (6, 1), (6, 2), (6, 3), (7, 2), (7, 4), (7, 5)], "bucket long, id long")
    left = lambda roots: sorted(tuple(r) for r in common.open_members(rows, spark.createDataFrame(roots, "node long, root long")).select("bucket", "id", "root").collect())
    assert left([]) == [(6, 2, 2), (6, 3, 3), (7, 4, 4), (7, 5, 5)]
    assert left([(2, 2), (3, 2)]) == [(7, 4, 4), (7, 5, 5)]
    assert left([(4, 4), (5, 4)]) == [(6, 2, 2), (6, 3, 3)]


def test_steps_leave_no_shuffle_files(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    files = lambda: sum(disk.getAllFiles().apply(i).getName().startswith("shuffle_") for i in range(disk.getAllFiles().size()))
    before = files()
    kept = common.cut(spark.range(5000).groupBy((F.col("id") % 700).alias("k")).count())
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and kept.count() == 700
    assert spark.conf.get(common.CLEANUP) == "false"


def test_lines_keep_neither_bands_nor_texts(spark):
    docs = spark.createDataFrame([(i, f"one line that all have\nand one about number {i} and what follows it") for i in range(20)], "doc_id long, text string")
    gone = fuzzylines.line_groups(docs, "doc_id").collect()
    folder = pathlib.Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    left = list(folder.glob("lines-*"))
    assert gone and left and not list(folder.glob("bands-*")) and not list(folder.glob("texts-*"))
    assert all("bands" not in spark.read.parquet(str(x)).columns for x in left)


def test_crowds_of_near_copies_make_few_pairs_and_lose_no_link(spark):
    rng = random.Random(7)
    fresh = lambda: rng.getrandbits(63) - 2**62
    bases = [[fresh() for _ in range(200)] for _ in range(2)]
    bases[1][:30] = bases[0][:30]
    sets = {}
    for i in range(1, 301):
        base = list(bases[i % 6 == 0])
        # The first one is far from the others, so that it links none of them.
        for _ in range(12 if i == 1 else rng.randrange(7)):
            at = 5 * rng.randrange(40)
            base[at:at + 5] = [fresh() for _ in range(5)]
        sets[i] = set(base)
    alike = lambda a, b: 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    links = lambda pairs: {r.node: r.root for r in common.components(frame(pairs, "a long, b long")).collect()}
    tested = frame([(i, 1, len(sets[i] & sets[1])) for i in sets if i > 1], "a long, b long, overlap long")
    rows, roots = frame([(5, i) for i in sets] + [(6, i) for i in sets if i % 3], "bucket long, id long"), frame([], "node long, root long")
    stars = [(i, 1) for i in sets if i > 1 and alike(i, 1)]
    want = links([(a, b) for a in sets for b in sets if b < a and alike(a, b)])
    every = frame([(i, h) for i, x in sets.items() for h in x], "id long, h long")
    plain = lambda ids: common.parity_sketch(every.join(ids, "id", "left_semi")).withColumn("shared", F.col("size"))
    whole = lambda ids: frame([(i, sorted(x)) for i, x in sets.items()], "id long, set array<long>").join(ids, "id", "left_semi")
    counts = []
    for crowd in (1000, 50):
        got = [tuple(r) for r in common.open_pairs(rows, roots, tested, 0.8, plain, whole, crowd).collect()]
        assert links([x for x in got if alike(*x)] + stars) == want
        counts.append(len(got))
    alike_pairs = sum(alike(a, b) for a in sets for b in sets if 1 < b < a)
    assert counts[0] < 2 * alike_pairs and counts[1] < 5 * len(sets) < alike_pairs


def test_sketches_differ_in_no_more_than_the_bags(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(1, 400))) for _ in range(12)] + ["", "a a a a a a a a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    owner, h, n = bagminhash.bags(texts, 5)
    bags = [Counter({int(x): int(c) for o, x, c in zip(owner, h, n) if o == i}) for i in range(len(texts))]
    outline = {r.id: r for r in bagminhash.outlines(docs, bagminhash.SETTINGS).collect()}
    sets = {r.id: r.set for r in bagminhash.bag_sets(docs, bagminhash.SETTINGS).collect()}
    again = {r.id: (r.size, r.sketch) for r in common.parity_sketch(spark.createDataFrame(
        [(i, x) for i, y in sets.items() for x in y], "id long, h long")).collect()}
    for i, x in enumerate(bags):
        assert outline[i].size == len(set(sets[i])) == x.total()
        assert not x or again[i] == (outline[i].size, outline[i].sketch)
        for j, y in enumerate(bags):
            differ = sum(((a ^ b) & (2**64 - 1)).bit_count() for a, b in zip(outline[i].sketch, outline[j].sketch))
            assert len(set(sets[i]) & set(sets[j])) == (x & y).total() and differ <= x.total() + y.total() - 2 * (x & y).total()


# Operator 6

def test_base_counts_by_hand(spark):
    text = "a b c d e f\na b c d e g\n\nx|y $5\nx|y $5"
    row = quality.base_counts(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (16, 22, 4, 1, 10)


def test_covered_words_overlap(spark):
    texts = ["a a a a a a a", "p q r s t u p q r s t u v", "one two three four", "m n o p q r m n o p q"]
    df = quality.base_counts(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"))
    assert [r.n_repeat_words for r in df.orderBy("doc_id").collect()] == [7, 12, 0, 10]


def test_divergent_documents_are_rejected(spark):
    words = quality.COMMON_WORDS["en"].split()
    rng = random.Random(2)
    plain = lambda: " ".join(rng.choice(words) + rng.choice(["", "s", "ing", "er"]) for _ in range(300))
    rows = [(i, plain(), "en") for i in range(40)]
    rows += [(100, " ".join(f"{rng.randrange(10**6)}#{rng.randrange(9)}" for _ in range(200)), "en"), (101, " ".join(f"zq{i}k" for i in range(300)), "en")]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(kept[i] for i in range(40)) and not kept[100] and not kept[101]


def test_scripts_without_case_are_held_against_their_own(spark):
    rng = random.Random(3)
    words = quality.COMMON_WORDS["en"].split()
    signs = [chr(c) for c in range(0x4E00, 0x4E00 + 400)]
    chinese = lambda: "\u3002 ".join("".join(rng.choice(signs) for _ in range(rng.randrange(6, 30))) for _ in range(40))
    english = lambda: " ".join(rng.choice(words) + rng.choice(["", "s", "ing", "er"]) for _ in range(300))
    rows = [(i, english(), "en") for i in range(40)] + [(100 + i, chinese(), "zh") for i in range(60)]
    rows += [(200, chinese(), None), (201, chinese(), "ja"), (202, "one two", None), (300, english(), "zh"), (301, chinese(), "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in quality.quality_rules(df).collect()}
    assert all(got[i].kept for i in [*range(40), *range(100, 160), 200, 201]) and not got[202].kept
    assert not got[300].kept and not got[301].kept
    assert got[200].class_distance is None and got[201].class_distance is None and got[100].word_distance is None


def test_distance_is_a_distance(spark):
    df = spark.createDataFrame([([3.0, 1.0], [0.75, 0.25]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [0.5, 0.5])], "c array<double>, r array<double>")
    same, apart, empty = [r[0] for r in df.select(quality.distance(F.col("c"), F.col("r"))).collect()]
    assert same == pytest.approx(0) and apart == pytest.approx(1) and empty == 0


def test_quality_of_odd_rows(spark, odd_docs):
    rows = quality.quality_rules(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(not r.kept for r in rows if not r.n_words)
    assert quality.quality_rules(odd_docs.limit(0)).count() == 0
    kept = quality.quality_stage(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns and {r.doc_id for r in kept.select("doc_id").collect()} == {4, 5, 6}


# Operator 7

def test_rule_choice_and_hosts(spark):
    cases = {
        "http://A.Example.ORG/es/1?x": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "https://example.org/en/12": ("example.org", "/en/12", "example.org/en/1", "block"),
        "https://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://x.com/de/#a://b": ("x.com", "/de/", "com/de/", "block"),
        "http://notexample.org": ("notexample.org", "", None, "allow"),
        "x://h?q=://other/": ("h", "", None, "allow"), "no scheme": ("", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(cases)], "page_id long, url string, html string")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in urls.url_filter(pages).collect()}
    assert got == cases


def test_blocks_travel_along_links_and_allow_goes_first(spark):
    canon = lambda u: f'<html><link rel="canonical" href="{u}">'
    rows = [
        (1, "http://a.net/1", canon("http://b.com/de/1")), (2, "http://b.com/de/1", ""), (3, "http://c.net/", '<meta http-equiv="refresh" content="0; url=http://a.net/1">'),
        (4, "http://d.net/x", canon("http://e.com/fr/1")), (5, "http://e.com/fr/1", canon("http://b.com/de/9")), (6, "http://b.com/de/9", None),
        (7, "https://www.c.net?utm_source=x#top", ""), (8, "http://f.net/p/q", canon("/de/2")), (9, "http://g.net/z", canon("//b.com/de/77")), (10, "https://b.com/de/77/", ""),
    ]
    df = spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], "page_id long, url string, html string, verdict string, node string")
    out = urls.url_filter(df)
    assert set(df.columns) <= set(out.columns)
    got = {r.page_id: r.verdict for r in out.collect()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "block", 7: "block", 8: "allow", 9: "block", 10: "block"}
    more = spark.createDataFrame([("http://f.net/p/q", "http://b.com/de/1")], "from_url string, to_url string")
    assert {r.page_id: r.verdict for r in urls.url_filter(df, redirects=more).collect()}[8] == "block"
    assert urls.url_filter(df.limit(0)).count() == 0 and urls.url_filter(df, rules=()).where("verdict = 'block'").count() == 0


# Operator 9

def test_windows_keep_budget_order_and_mask(spark):
    rng = random.Random(4)
    rows = []
    for c in range(6):
        if c % 2:
            rows.append((c, 0, "system", "be kind"))
        for t in range(1, rng.randrange(2, 40)):
            rows.append((c, t, "user" if t % 2 else "assistant", " ".join("word" for _ in range(rng.choice([1, 30, 200, 900])))))
    rows += [(7, 3, None, None), (7, None, "assistant", "<|start|>x<|end|> </s> [INST] <\\|start|>"), (7, 3, None, None), (None, 1, "a%<[25", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.chat_windows(df)
    for w in windows.collect():
        assert w.n_tokens <= chat.BUDGET.window_tokens or w.over_budget and w.n_turns - w.n_repeated == 1
        for s in w.loss_spans:
            assert w.formatted[: s.start].endswith("<|start|>assistant<|head|>") and w.formatted[s.end :].startswith("<|end|>")
        assert w.formatted.count("<|start|>") == w.n_turns
    got = {r.conv_id: r for r in chat.conversation_digests(windows).collect()}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=key)
        told = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(own), hashlib.sha256(told.encode()).hexdigest())
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.chat_windows(df.limit(0)).count() == 0


def test_long_system_turn_opens_every_window(spark):
    rows = []
    for c, size in enumerate((100, 490, 1500, 3000, 6000)):
        rows.append((c, 0, "system", "s" * size))
        rows += [(c, t, "user" if t % 2 else "assistant", "w" * 300) for t in range(1, 30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    windows = chat.chat_windows(df).collect()
    assert {w.conv_id for w in windows if w.window > 1} == set(range(5))
    for w in windows:
        system = "<|start|>system<|head|>" + rows[30 * w.conv_id][3] + "<|end|>"
        assert w.formatted.startswith(system) and w.formatted.count("<|start|>system") == 1
        assert w.n_tokens <= chat.BUDGET.window_tokens or w.over_budget and (w.conv_id == 4 or w.n_turns - w.n_repeated == 1)
        assert w.n_turns > 1 and w.over_budget == (w.n_tokens > chat.BUDGET.window_tokens)
    assert all(w.over_budget for w in windows if w.conv_id == 4) and not any(w.over_budget for w in windows if w.conv_id < 3)
    got = chat.conversation_digests(chat.chat_windows(df)).collect()
    assert all(r.n_turns == 30 and r.loss_chars == 14 * 300 for r in got)


def test_escape_round_trip(spark):
    rng = random.Random(5)
    parts = ["<", "|", "\\", "s>", "/s>", "[", "INST]", "/INST]", "x", "<|start|>", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", chat.escape(F.col("t")).alias("e")).withColumn("b", chat.unescape(F.col("e")))
    for r in df.collect():
        assert r.b == r.t and not any(m in r.e for m in ("<|", "</s>", "<s>", "[INST]", "[/INST]"))


# Operator 5

def test_licences_by_whole_text_and_line(spark):
    mit = licenses.MIT + licenses.AS_IS
    rows = [
        (1, mit), (2, "Copyright (c) 2020 A. Body\n\n" + mit.upper().replace(",", " ;")), (3, mit + " more"), (4, "text\nreleased  under the MIT license!\nmore"),
        (5, "Licenced under the Apache Licence, version 2.0"), (6, None), (7, ""), (8, "Released under the MIT License.\nreleased under the mit license"), (9, "...\n© 2020"),
    ]
    df = spark.createDataFrame([r + ("x", "y") for r in rows], "doc_id long, text string, license string, digest string")
    got = {r.doc_id: (r.license, r.notices, r.n_notices) for r in licenses.license_scan(df, licenses.known_digests(spark)).collect()}
    assert got == {
        1: ("MIT", ["MIT"], 1), 2: ("MIT", ["MIT"], 1), 3: (None, [], 0), 4: (None, ["MIT"], 1), 5: ("Apache-2.0", ["Apache-2.0"], 1),
        6: (None, [], 0), 7: (None, [], 0), 8: (None, ["MIT"], 2), 9: (None, [], 0)}
    assert licenses.license_scan(df.limit(0), licenses.known_digests(spark)).count() == 0


def test_long_licences_and_standard_headers(spark):
    apache = "   Licensed under the Apache License, Version 2.0 (the \"License\");\n   you may not use this file except in compliance with the License.\n"
    bsd = """BSD 2-Clause License

Copyright (c) 2021, A. Body
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
    texts = {0: ("code\n" + apache + "code", None, ["Apache-2.0"]), 1: (bsd, "BSD-2-Clause", []), 2: ("\n" * 300 + bsd.lower(), "BSD-2-Clause", []),
             3: ("# SPDX-License-Identifier: GPL-3.0-or-later\nx", None, ["GPL-3.0-or-later"]), 4: (bsd.replace("binary form", "any form"), None, [])}
    for k, (name, file) in enumerate((
            ("Apache-2.0", "Apache-2.0"), ("BSD-3-Clause", "BSD"), ("CC0-1.0", "CC0-1.0"), ("GPL-2.0-only", "GPL-2"), ("GPL-3.0-only", "GPL-3"),
            ("LGPL-2.1-only", "LGPL-2.1"), ("LGPL-3.0-only", "LGPL-3"), ("MPL-2.0", "MPL-2.0"))):
        path = pathlib.Path("/usr/share/common-licenses", file)
        if path.exists():
            texts[10 + k] = (path.read_text(), name, None)
    df = spark.createDataFrame([(i, t) for i, (t, _, _) in texts.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_scan(df, licenses.known_digests(spark)).collect()}
    assert {i: got[i].license for i in texts} == {i: name for i, (_, name, _) in texts.items()}
    assert all(notices is None or got[i].notices == notices for i, (_, _, notices) in texts.items())


def test_windows_with_system_turns_of_any_length_agree_with_the_twin(spark):
    rng = random.Random(21)
    rows = []
    for c in range(12):
        rows.append((c, 0, "system", "s" * (0, 300, 508, 600, 1500, 5000)[c % 6]))
        rows += [(c, k, ("user", "assistant")[k % 2], "x|<|y" * rng.randrange(1, 200)) for k in range(1, rng.randrange(2, 30))]
    rows += [(20, 0, "user", None), (21, 0, "system", "t" * 3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    db = duckdb.connect()
    db.register("conversations", df.toPandas())
    want = {r[0]: tuple(r) for r in db.execute(chat._SQL).fetchall() if r[0] >= 0}
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    got = {r.conv_id: tuple(r[n] for n in names) for r in chat.conversation_digests(chat.chat_windows(df)).collect()}
    assert got == want


def test_rewrapped_licences_keep_their_lines_about_copyright(spark):
    texts = [(n, t) for n, t in licenses.LICENSES + licenses.TEXTS if len(t) > 200]
    wrap = lambda t, w: "\n".join("\n".join(textwrap.wrap(x, w)) for x in t.split("\n"))
    rows = [(k * 100 + w, n, head + wrap(t, w)) for k, (n, t) in enumerate(texts) for w in range(60, 101, 2)
            for head in ("Copyright 2020 A. Body\n© B. Body 2021\n\n",)[: 1 if w % 4 else 0] or ("",)]
    assert sum("\ncopyright " in x.lower().split("\n\n")[-1] for _, _, x in rows) > 5
    df = spark.createDataFrame(rows, "doc_id long, want string, text string")
    got = {r.doc_id: r.license for r in licenses.license_scan(df, licenses.known_digests(spark)).collect()}
    assert {i: got[i] for i, _, _ in rows} == {i: n for i, n, _ in rows}


# Operator 2

def _brute_lines(docs, similarity, width):
    def cut(line):
        return {line[i : i + width] for i in range(len(line) - width + 1)} if len(line) >= width else {line}

    places = [(d, i, x) for d, t in docs for i, x in enumerate(t.split("\n")) if re.search(r"[^\x20\x09-\x0D]", x)]
    lines = sorted({x for _, _, x in places})
    sets, root = [cut(x) for x in lines], list(range(len(lines)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(lines)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n >= similarity * (len(sets[i]) + len(sets[j]) - n):
                root[find(i)] = find(j)
    group = {x: find(i) for i, x in enumerate(lines)}
    first = {}
    for d, i, x in sorted(places):
        first.setdefault(group[x], (d, i))
    return {(d, i) for d, i, x in places if first[group[x]] != (d, i)}


def test_near_equal_lines_against_brute_force(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijkl") for _ in range(rng.randrange(2, 9)))
    base = [" ".join(word() for _ in range(30)) for _ in range(25)]
    docs = []
    for d in range(60):
        lines = []
        for _ in range(5):
            words = rng.choice(base).split() if rng.random() < 0.7 else [word() for _ in range(20)]
            if rng.random() < 0.5:
                words[rng.randrange(len(words))] = word()
            lines.append(" ".join(words))
        docs.append((d, "\n".join(lines + ["", "ab"])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    gone = {(r.doc, n) for r in fuzzylines.line_groups(df, "doc_id").collect() for n in r.nos}
    want = _brute_lines(docs, 0.8, 5)
    assert gone <= want and len(want - gone) <= 0.01 * len(want)
    out = {r.doc_id: r for r in fuzzylines.dedup_lines(df).collect()}
    for d, t in docs:
        kept = [x for i, x in enumerate(t.split("\n")) if (d, i) not in gone]
        assert out[d].text == "\n".join(kept) and out[d].n_removed == sum(k == d for k, _ in gone) and out[d].n_lines == 6


def test_recall_of_bands_by_length_and_without_blanks(spark):
    rng = random.Random(13)
    cut = lambda x: {x[i : i + 5] for i in range(len(x) - 4)}
    plain = "abcdefghijklmnopqrstuvwxyz"
    alphabets = {"spaced": plain + "     ", "unspaced": plain + "0123456789/+", "han": "".join(chr(0x4E00 + i) for i in range(400))}
    pairs = []
    for kind, letters in alphabets.items():
        some = lambda n: "x" + "".join(rng.choice(letters) for _ in range(n - 2)) + "x"
        for length in (12, 30, 60, 150, 400, 900):
            n = length - 4
            for k in range(60):
                a = some(length)
                b = list(a)
                for at in rng.sample(range(5, length - 5), n // 45):
                    b[at] = rng.choice(letters)
                b = "".join(b) if n >= 45 and k % 3 == 0 else a + some(2 + n // 5)[2:] if k % 3 == 1 or n < 9 else some(2 + n // 9)[2:] + a[n // 9 :]
                if a != b and len(cut(a) & cut(b)) >= 0.8 * len(cut(a) | cut(b)):
                    pairs.append((kind, length, a, b))
    df = spark.createDataFrame(pairs, "kind string, length long, a string, b string")
    met = F.arrays_overlap(fuzzylines.bands_of(F.col("a"), fuzzylines.SETTINGS), fuzzylines.bands_of(F.col("b"), fuzzylines.SETTINGS))
    rows = df.groupBy("kind", "length").agg(F.avg(met.cast("double")).alias("recall")).collect()
    assert len(rows) == 18 and all(r.recall >= 0.95 for r in rows) and sum(r.recall for r in rows) / 18 >= 0.99


def test_lines_that_meet_by_chance_are_told_apart_without_their_texts(spark, monkeypatch):
    rng = random.Random(29)
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
    lines = [" ".join(rng.choice(vocabulary) for _ in range(9 if i % 2 else 40)) for i in range(600)]
    lines += [line + "x" for line in lines[:30]]
    compared, whole = [], fuzzylines._compared
    monkeypatch.setattr(fuzzylines, "_compared", lambda pairs, *rest: (compared.extend(pairs.select("a", "b").collect()), whole(pairs, *rest))[1])
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    gone = {(r.doc, n) for r in fuzzylines.line_groups(df, "doc_id").collect() for n in r.nos}
    assert gone == {(600 + i, 0) for i in range(30)} == _brute_lines(list(enumerate(lines)), 0.8, 5)
    assert 30 <= len(compared) <= 60


def test_line_sketches_differ_in_no_more_than_the_sets_and_deals_are_the_bands(spark):
    rng = random.Random(31)
    pairs = []
    for length in (1, 4, 5, 9, 60, 68, 70, 84, 90, 300, 2000):
        for edits in (0, 1, 3, length // 9, length):
            a = [rng.choice("abcdefghijklmnop ") for _ in range(length)]
            b = list(a)
            for at in rng.sample(range(length), min(edits, length)):
                b[at] = rng.choice("abcdefghijklmnop ")
            pairs.append(("".join(a), "".join(b)))
    s = fuzzylines.SETTINGS
    lines = spark.createDataFrame([(2 * i + j, x) for i, p in enumerate(pairs) for j, x in enumerate(p)], "id long, line string")
    found = {r.id: r for r in fuzzylines.with_buckets(lines, s).collect()}
    plain = {r.id: r for r in lines.select("id", F.sort_array(fuzzylines.bands_of(F.col("line"), s)).alias("bands"), fuzzylines.shingle_set(F.col("line"), s.width).alias("set")).collect()}
    for i in range(len(pairs)):
        (a, b), (x, y) = [plain[2 * i + j] for j in (0, 1)], [found[2 * i + j] for j in (0, 1)]
        differ = sum(((v ^ w) & (2**64 - 1)).bit_count() for v, w in zip(x.sketch, y.sketch, strict=True))
        assert differ <= len(set(a.set) ^ set(b.set)) and (x.size, y.size) == (len(a.set), len(b.set))
        for r, whole in ((x, a), (y, b)):
            assert sorted(v for k in range(fuzzylines.DEALS) for v in r[f"bands_{k}"]) == whole.bands


def test_crowded_buckets_are_left_whole(spark, monkeypatch):
    monkeypatch.setattr(fuzzylines, "CROWD", 4)
    lines = [f"a line of some length that all have but for number {i}" for i in range(12)] + ["nothing of this kind is found anywhere else, at all"]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    gone = {(r.doc, n) for r in fuzzylines.line_groups(df, "doc_id").collect() for n in r.nos}
    assert gone == {(i, 0) for i in range(1, 12)} == _brute_lines(list(enumerate(lines)), 0.8, 5)
    folder = pathlib.Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    assert not [x for kind in ("members", "met", "bands", "texts") for x in folder.glob(f"{kind}-*")]


def test_lines_of_odd_rows(spark, odd_docs):
    out = fuzzylines.dedup_lines(odd_docs)
    assert out.columns == odd_docs.columns + ["n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].text is None and by[2].text == "" and by[7].text == "\n\n\n" and by[None].text == "no key here"
    assert by[5].n_removed == 0 and by[6].n_removed == 1 and by[6].text == "" and all(r.n_removed == 0 for r in rows if r.doc_id == 4)
    assert fuzzylines.dedup_lines(odd_docs.limit(0)).count() == 0


def test_no_python_in_native_plans(spark):
    folder = "/root/testdata/sf0.001"
    from larkspur import llm

    for name in ("op5_license_scans", "op6_quality_rules", "op7_url_filters", "op9_chat_formatting", "op2_line_dedup"):
        plan = llm.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)
