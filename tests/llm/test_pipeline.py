"""The corpus pipeline: every stage's decisions, on the driver's tables and on awkward ones."""

import re

import pytest
from test_queries import brute_components, brute_fingerprint

import corpus_pipeline
from starloom.llm import quality
from starloom.llm.common import table
from starloom.llm.decontaminate import words_of

SF = "/root/testdata/sf0.01"
SECRET = re.compile(r"AKIA[A-Z0-9]{16,}|(?<![0-9a-f])[0-9a-f]{24,}")


@pytest.fixture(scope="module", params=["driver", "edge"])
def stages(request, spark, edge, tmp_path_factory):
    folder = SF if request.param == "driver" else edge
    docs, out = table(spark, folder, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, folder)
        path = str(tmp_path_factory.mktemp(request.param)) + "/out"
        got.write.parquet(path)
        out[name] = (docs, spark.read.parquet(path))
        docs = out[name][1]
    return folder, out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_stages_keep_the_columns(stages):
    _, out = stages
    for name, (before, after) in out.items():
        if name != "sentencepiece":
            assert after.dtypes == before.dtypes


def test_quality_drops_what_the_classifier_rejects(spark, stages):
    folder, out = stages
    before, after = out["quality"]
    model = quality.fit(before, table(spark, folder, "labels"))
    good = [r for r in before.collect() if model.score([quality.vector(r["text"])])[0] >= quality.THRESHOLD]
    assert sorted((tuple(r) for r in good), key=str) == rows(after)


def test_one_document_of_each_group_stays(stages):
    _, out = stages
    before, after = out["simhash"]
    docs = before.collect()
    comp = brute_components([r["doc_id"] for r in docs], [brute_fingerprint(r["text"]) for r in docs])
    named = sorted(c for c in set(comp) if c is not None)
    assert sorted(r["doc_id"] for r in after.collect() if r["doc_id"] is not None) == named
    assert set(rows(after)) <= set(rows(before))


def test_no_window_of_the_benchmark_is_left(spark, stages):
    folder, out = stages
    before, after = out["decontaminate"]
    windows = set()
    for r in table(spark, folder, "benchmark").collect():
        w = words_of(r["text"])
        windows |= {tuple(w[i:i + 10]) for i in range(max(1, len(w) - 9))} if w else set()
    sizes = {len(w) for w in windows}

    def hit(text):
        w = words_of(text)
        return any(tuple(w[i:i + n]) in windows for n in sizes for i in range(len(w) - n + 1))

    old = {(r["doc_id"], r["lang"], r["source"]): r for r in before.collect()}
    assert after.count() == before.count()
    for r in after.collect():
        assert not hit(r["text"])
        was = old[r["doc_id"], r["lang"], r["source"]]
        if was["doc_id"] is not None and not hit(was["text"]):
            assert r["text"] == was["text"] and r["n_chars"] == was["n_chars"]


def test_no_secret_is_left(stages):
    _, out = stages
    before, after = out["secrets"]
    assert after.count() == before.count()
    assert not [r["doc_id"] for r in after.collect() if SECRET.search(r["text"] or "")]
    assert sum("[SECRET]" in (r["text"] or "") for r in after.collect()) > 0


def test_encoded_documents(stages):
    import hashlib

    import sentencepiece

    from starloom.llm import queries

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.model_path(queries.PIECE_MODEL))
    _, out = stages
    before, after = out["sentencepiece"]
    want = sorted(sp.encode(r["text"] or "", add_eos=True) for r in before.collect())
    got = after.collect()
    assert sorted(list(r["ids"]) for r in got) == want
    assert all(r["ids_sha256"] == hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() for r in got)


def test_run_on_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0
