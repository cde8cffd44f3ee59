from __future__ import annotations

import corpus_pipeline
from tests.llm.test_decontamination import brute
from tests.llm.test_simhash import groups_of, plain_fingerprint
from tests.llm.test_suffix_dedup import brute as repeats

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_turn(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    frames = []
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, sf_dir), "stage")
        frames.append(docs)
        if name != names[-1]:
            assert docs.columns == COLUMNS
    kept = [{r["doc_id"]: r for r in f.collect()} for f in frames]
    start = {r["doc_id"]: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in kept[0] for i in good) > 0.95 * len(good)

    rows = [(i, r["text"]) for i, r in kept[0].items()]
    group, least = groups_of(rows), {}
    for i, t in rows:
        g = group[plain_fingerprint(t)]
        least[g] = min(least.get(g, i), i)
    assert set(kept[1]) == set(least.values())
    assert all(kept[1][i]["text"] == start[i]["text"] for i in kept[1])

    ids = list(kept[1])
    want = dict(zip(ids, repeats([kept[1][i]["text"] for i in ids])))
    assert set(kept[2]) == set(ids)
    for i in ids:
        assert len(kept[2][i]["text"].encode()) == want[i][0] - want[i][1] and kept[2][i]["n_chars"] == len(kept[2][i]["text"])

    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in brute([(i, r["text"]) for i, r in kept[2].items()], items) if r[5]}
    assert set(kept[3]) == set(kept[2]) - hit
    assert set(kept[4]) == set(kept[3])


def test_run_gives_the_rows_of_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    assert all(len(r["ids"]) == r["n_tokens"] for r in out.collect())


def test_stages_take_missing_values(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (2, "some words " * 30, None, "s", 5), (2, "some words " * 30, None, "s", 5)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), sf_dir).collect() == []
        stage(spark, docs, sf_dir).collect()
