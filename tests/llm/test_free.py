"""Operators 1, 3, 4, 8 and 10."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from larkspur.llm import bagminhash, decontam, langid, pieces, suffixes

FOLDER = "/root/testdata/sf0.01"


# Operator 1

def test_held_out_accuracy(spark):
    from larkspur import llm

    pred = llm.QUERIES["op1_language_id"](spark, FOLDER)
    truth = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = pred.join(truth, "doc_id").where("lang IS NOT NULL").collect()
    right = [r.lang_pred == r.lang for r in rows if r.held_out]
    assert sum(right) >= 0.97 * len(right) and all(0 <= r.score <= 1 for r in rows)
    sure = [r.lang_pred == r.lang for r in rows if r.held_out and r.accepted]
    assert sum(sure) >= 0.98 * len(sure)


def test_language_of_odd_rows(spark, odd_docs):
    model = langid.train(langid.sample(odd_docs.where("lang IS NOT NULL")))
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(odd_docs, model).collect()]
    assert len(got) == odd_docs.count()
    assert all(lang == "und" and s == 0 for d, lang, s in got if d in (1, 2, 3, 7)) and all(lang in model.langs for d, lang, _ in got if d in (4, 5, 6, 8, None))
    nothing = langid.train(langid.sample(odd_docs.limit(0)))
    assert {r.lang_pred for r in langid.identify(odd_docs, nothing).collect()} == {"und"}
    assert langid.identify(odd_docs.limit(0), model).count() == 0


def test_pieces_of_a_long_text_add_up():
    text = "Größe und Länge 12, über alle Straßen. " * 50
    whole = np.sort(np.concatenate(list(langid.subwords(text, (2, 3, 4), 1 << 15))))
    for size in (7, 64, 100_000):
        assert (np.sort(np.concatenate(list(langid.subwords(text, (2, 3, 4), 1 << 15, size)))) == whole).all()


# Operator 3

@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary.load()


def _slow(unit, v):
    table = {int(k): (int(i), s) for k, i, s in zip(v.keys, v.ids, v.scores)}
    best = [(0.0, [])]
    for end in range(1, len(unit) + 1):
        options = []
        for size in range(1, min(end, v.longest) + 1):
            hit = table.get(int(pieces._hash(unit[end - size : end])))
            if hit:
                options.append((best[end - size][0] + hit[1], best[end - size][1] + [hit[0]]))
            elif size == 1:
                options.append((best[end - 1][0] + v.unknown, best[end - 1][1] + v.byte_ids[list(unit[end - 1].replace(pieces.SPACE, " ").encode())].tolist()))
        best.append(max(options, key=lambda o: o[0]))
    return best[-1][0]


def test_viterbi_is_best_and_round_trips(vocabulary):
    v, rng = vocabulary, random.Random(8)
    texts = ["", " ", "  two  blanks ", "a\nb\tc\r\n", "▁literal ▁▁ x", "東京 😀 naïve", "x" * 3000, "\U0010fffe▁a \U0010fffe", "\U0010fffe", "Hello world, the end."]
    texts += ["".join(rng.choice("abc ehtn.,\né▁") for _ in range(rng.randrange(40))) for _ in range(200)]
    encoder = pieces.Encoder(v)
    ids = encoder.encode(texts)
    assert [encoder.decode(x) for x in ids] == texts
    assert [x.tolist() for x in pieces.Encoder(v).encode(texts[::-1])][::-1] == [x.tolist() for x in ids]
    score = dict(zip(v.ids.tolist(), v.scores.tolist()))
    units = ["▁" + "".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(1, 14))) for _ in range(300)]
    flat, first, size = pieces.viterbi(units, v)
    for unit, a, n in zip(units, first, size):
        assert sum(score[i] for i in flat[a : a + n].tolist()) == pytest.approx(_slow(unit, v))


def test_pieces_agree_with_the_library_where_it_has_no_choice(vocabulary):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    encoder = pieces.Encoder(vocabulary)
    texts = ["Hello world, the end.", "naïve 東京", "tabs\tand\nlines"]
    assert [lib.decode(x.tolist()) for x in encoder.encode(texts)] == texts


def test_encoding_of_odd_rows(spark, odd_docs, vocabulary):
    rows = pieces.encode(odd_docs, vocabulary).collect()
    assert len(rows) == odd_docs.count() and all(r.round_trip for r in rows)
    by = {r.doc_id: r for r in rows}
    assert by[1].ids is None and by[2].ids == [] and by[1].decoded_sha256 is None and by[5].n_pieces == len(by[5].ids)
    assert pieces.encode(odd_docs.limit(0), vocabulary).count() == 0


# Operator 4

def _slow_cut(docs, length):
    grams = Counter(b[i : i + length] for b in docs for i in range(len(b) - length + 1))
    out = []
    for b in docs:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if grams[b[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(bytes(np.frombuffer(b, np.uint8)[~gone]))
    return out


def test_repeated_starts_against_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        length = rng.choice([2, 3, 5, 12, 40])
        base = bytes(rng.choice(b"abc") for _ in range(120))
        strings = []
        for _ in range(rng.randint(1, 6)):
            at = rng.randint(0, 60)
            s = bytearray(base[at : at + rng.randint(0, 90)])
            for _ in range(rng.randint(0, 2)):
                if s:
                    s[rng.randrange(len(s))] = rng.choice(b"abcd\0")
            strings.append(bytes(s))
        grams = Counter(s[i : i + length] for s in strings for i in range(len(s) - length + 1))
        want = [[i for i in range(len(s) - length + 1) if grams[s[i : i + length]] > 1] for s in strings]
        assert [x.tolist() for x in suffixes.repeated_starts(strings, length)] == want


@pytest.mark.parametrize("settings", [
    suffixes.Settings(length=40, blocks=(16, 4, 1), group=2000, shard=5000), suffixes.Settings(length=40, blocks=(16, 4, 1), group=3, shard=500)])
def test_repeats_against_brute_force(spark, settings):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 8)))
    base = [" ".join(word() for _ in range(60)) for _ in range(6)]
    texts = [None, "", "short", "aaaa" * 60, "ab" * 200]
    for _ in range(70):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = word()
        cut = rng.randrange(0, 20)
        texts.append(" ".join(words[cut:]) + " " + " ".join(word() for _ in range(rng.randrange(20))))
    texts += texts[-3:]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in suffixes.remove_repeats(df, s=settings).collect()}
    for i, (t, want) in enumerate(zip(texts, _slow_cut([(t or "").encode() for t in texts], 40))):
        assert bytes(got[i].kept) == want and got[i].n_bytes == len((t or "").encode())
        assert got[i].n_bytes - len(want) == sum(s.stop - s.start for s in got[i].spans)


def test_repeats_of_odd_rows(spark, odd_docs):
    rows = suffixes.remove_repeats(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert by[1].n_bytes == 0 and not by[4].spans and len(by[5].kept) == 0 and len(by[6].kept) < 10
    assert suffixes.remove_repeats(odd_docs.limit(0)).count() == 0


def test_repeats_of_rows_without_a_key(spark):
    rng = random.Random(21)
    noise = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    shared = noise(2259)
    texts = [(None, noise(100) + shared + noise(300)), (3, shared + noise(500)), (None, noise(900)), (0, noise(50) + shared[:700] + noise(20)), (None, noise(300))]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = {(r.doc_id, r.n_bytes): (bytes(r.kept), [tuple(x) for x in r.spans]) for r in suffixes.remove_repeats(docs).collect()}
    for (key, text), kept in zip(texts, _slow_cut([t.encode() for _, t in texts], 400)):
        assert got[key, len(text)][0] == kept
    assert len(got[None, 2659][1]) == len(got[3, 2759][1]) == 1 and got[None, 900][1] == []


# Operator 8

def _slow_align(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            h[i + 1][j + 1] = max(0, h[i][j] + (1 if a[i] == b[j] else -1), h[i][j + 1] - 1, h[i + 1][j] - 1)
    return max(map(max, h))


def test_smith_waterman_against_brute_force():
    rng = np.random.default_rng(1)
    left = [rng.integers(0, 5, rng.integers(1, 12)).astype(np.uint64) for _ in range(60)]
    right = [rng.integers(0, 5, rng.integers(0, 25)).astype(np.uint64) for _ in range(60)]
    assert decontam.smith_waterman(left, right).tolist() == [_slow_align(a.tolist(), b.tolist()) for a, b in zip(left, right)]


def test_edited_copies_are_found_and_others_left(spark):
    rng = random.Random(10)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 9)))
    items = [[word() for _ in range(rng.randrange(20, 50))] for _ in range(30)] + [["only", "two"], ["x"]]
    noise = lambda n: [word() for _ in range(n)]
    docs, want = [], {}
    for i, item in enumerate(items[:30]):
        edited = list(item)
        for k in range(0, len(item), 9):
            edited[k] = word() if rng.random() < 0.6 else edited[k] + " " + word()
        docs.append((i, " ".join(noise(80) + edited + noise(50)).upper().replace(" ", ", ")))
        want[i] = [i]
    docs += [(100 + i, " ".join(noise(200))) for i in range(30)] + [(200, " ".join(items[0][:6])), (201, None), (202, ""), (203, "say only two things"), (None, " ".join(items[1]))]
    df = spark.createDataFrame([d + ("x",) for d in docs], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)] + [(50, None), (51, "")], "item_id long, text string")
    for settings in (decontam.SETTINGS, decontam.Settings(block_chars=1500)):
        got = {r.doc_id: r["items"] for r in decontam.decontaminate(df, bench, s=settings).collect()}
        assert got == {**{d: want.get(d, []) for d, _ in docs}, 203: [30], None: []}
    assert decontam.decontaminate(df, bench.limit(0)).where("contaminated").count() == 0 and decontam.decontaminate(df.limit(0), bench).count() == 0


def test_dense_edits_against_brute_force(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(8))
    items = [[word() for _ in range(n)] for n in (8, 12, 19, 30, 40, 60) for _ in range(4)]

    def edited(item, step, how):
        return [y for k, x in enumerate(item) for y in ((([word()] if how == "exchange" else [x, word()]) if k % step == step - 1 else [x]))]

    docs = [[word() for _ in range(20)] + edited(x, step, how) + [word() for _ in range(20)]
            for x in items for how, steps in (("exchange", (3, 4, 5, 6)), ("put in", (1, 2, 3))) for step in steps]
    want = {}
    for d, doc in enumerate(docs):
        codes = decontam.word_hashes([" ".join(doc)])[0].tolist()
        best = [_slow_align(decontam.word_hashes([" ".join(x)])[0].tolist(), codes) if set(x) & set(doc) else 0 for x in items]
        want[d] = [i for i, x in enumerate(items) if best[i] >= max(0.5 * len(x), min(8, len(x)))]
    df = spark.createDataFrame([(d, " ".join(x)) for d, x in enumerate(docs)], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string")
    assert sum(map(bool, want.values())) > 80
    assert {r.doc_id: r["items"] for r in decontam.decontaminate(df, bench).collect()} == want
    # Each pattern by itself, so that no other copy makes its broken pairs occur.
    for k in range(7):
        alone = {r.doc_id: r["items"] for r in decontam.decontaminate(df.where(f"doc_id % 7 = {k}"), bench).collect()}
        assert alone == {d: want[d] for d in want if d % 7 == k}


# Operator 10

def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(1)
    error = []
    for _ in range(40):
        element = rng.integers(0, 2**63, 150).astype(np.uint64)
        a = rng.integers(0, 9, 150)
        b = np.where(rng.random(150) < 0.6, a, rng.integers(0, 9, 150))
        owner = np.r_[np.zeros((a > 0).sum(), int), np.ones((b > 0).sum(), int)]
        signature = bagminhash.signatures(owner, np.r_[element[a > 0], element[b > 0]], np.r_[a[a > 0], b[b > 0]], 2, 512)
        error.append((signature[0] == signature[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert abs(np.mean(error)) < 0.01


def test_groups_against_brute_force(spark):
    rng = random.Random(11)
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(400))
    base = [[word() for _ in range(rng.randrange(40, 120))] for _ in range(12)]
    docs = []
    for d in range(250):
        words = list(rng.choice(base)) if rng.random() < 0.8 else [word() for _ in range(50)]
        for _ in range(rng.choice([0, 0, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = word()
        docs.append((d, " ".join(words)))
    owner, h, count = bagminhash.bags([t for _, t in docs], 5)
    cuts = np.searchsorted(owner, np.arange(len(docs) + 1))
    bag = [(h[x:y], count[x:y]) for x, y in zip(cuts, cuts[1:])]
    root = list(range(len(docs)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(docs)):
        for j in range(i):
            n = bagminhash.overlap(bag[i], bag[j])
            if n >= 0.8 * (bag[i][1].sum() + bag[j][1].sum() - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
    got = {r.doc_id: r for r in bagminhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {d: got[d].group_id for d, _ in docs} == {d: find(d) for d, _ in docs}
    sizes = Counter(find(d) for d, _ in docs)
    assert all(r.group_size == sizes[r.group_id] and r.kept == (r.group_id == d) for d, r in got.items())


def test_groups_of_odd_rows(spark, odd_docs):
    rows = bagminhash.near_duplicates(odd_docs).collect()
    groups = defaultdict(set)
    for r in rows:
        groups[r.group_id].add(r.doc_id)
    assert {5, 6} in groups.values() and {4} in groups.values() and {1} in groups.values() and {2} in groups.values()
    assert len(rows) == 9 and sum(r.kept for r in rows) == 8
    assert bagminhash.near_duplicates(odd_docs.limit(0)).count() == 0
