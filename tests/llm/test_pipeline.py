"""The pipeline, stage by stage, against brute force on the smallest tables."""

import duckdb
import numpy as np
import sentencepiece
from test_native import _brute_lines

import corpus_pipeline
from larkspur.llm import SQL, bagminhash, decontam, pieces

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark, tmp_path):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, tables = docs.columns, [{r.doc_id: r for r in docs.collect()}]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert k == 4 or docs.columns == columns
        tables.append({r.doc_id: r for r in docs.collect()})
    start, good, cut, single, clean, encoded = tables

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    assert {r[0] for r in con.execute(f"SELECT doc_id FROM ({SQL['op6_quality_rules']}) WHERE kept").fetchall()} == set(good)

    gone = _brute_lines([(d, r.text) for d, r in good.items()], 0.8, 5)
    assert set(cut) == set(good)
    for d, r in good.items():
        kept = "\n".join(x for i, x in enumerate(r.text.split("\n")) if (d, i) not in gone)
        assert cut[d].text == kept and cut[d].n_chars == len(kept)

    ids = sorted(cut)
    owner, h, n = bagminhash.bags([cut[d].text for d in ids], 5)
    at = np.searchsorted(owner, np.arange(len(ids) + 1))
    bag = [(h[x:y], n[x:y]) for x, y in zip(at, at[1:])]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            both = bag[i][1].sum() + bag[j][1].sum()
            shared = bagminhash.overlap(bag[i], bag[j])
            if cut[ids[i]].text == cut[ids[j]].text or shared and shared >= 0.8 * (both - shared):
                root[max(find(i), find(j))] = min(find(i), find(j))
    assert set(single) == {d for i, d in enumerate(ids) if find(i) == i}

    items = [r[0] for r in con.execute(f"SELECT text FROM '{FOLDER}/benchmark.parquet'").fetchall()]
    words, counts = decontam.word_hashes(items)
    item = np.split(words, np.cumsum(counts)[:-1])
    leaked = set()
    for d, r in single.items():
        doc = decontam.word_hashes([r.text])[0]
        best = decontam.smith_waterman(item, [doc] * len(item))
        if any(b >= max(0.5 * len(x), min(8, len(x))) for b, x in zip(best, item)):
            leaked.add(d)
    assert set(clean) == set(single) - leaked

    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_PATH)
    assert set(encoded) == set(clean)
    for d, r in encoded.items():
        assert r.round_trip and library.decode(list(r.ids)) == clean[d].text and r.n_pieces == len(r.ids)


def test_run_is_the_chain_of_stages(spark):
    out = corpus_pipeline.run(spark, FOLDER)
    assert out.columns == ["doc_id", "ids", "n_pieces", "decoded_sha256", "round_trip"] and out.where("NOT round_trip").count() == 0
