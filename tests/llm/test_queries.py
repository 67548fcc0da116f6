"""Every opN query on the awkward tables and on empty ones, against SQL or brute force."""

import collections
import hashlib

import duckdb
import numpy as np
import pytest
import xxhash
from oracle import compare

from starloom.llm import queries
from starloom.llm.common import table
from starloom.llm.decontaminate import words_of
from starloom.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
PER_ROW = {"op2": "documents", "op3": "documents", "op4": "documents", "op5": "documents", "op6": "documents",
           "op7": "pages", "op10": "documents", "op12": "documents", "op13": "documents"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_awkward_rows(spark, edge, name):
    got = QUERIES[name](spark, edge)
    rows = got.collect()
    of = PER_ROW.get(name.split("_")[0])
    if of:
        assert len(rows) == table(spark, edge, of).count()
        key = got.columns[0]
        assert collections.Counter(r[key] for r in rows) == collections.Counter(
            r[key] for r in table(spark, edge, of).collect())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, edge, name):
    got = QUERIES[name](spark, empty)
    assert got.columns == QUERIES[name](spark, edge).columns
    assert got.count() == (1 if name.startswith("op8") else 0)  # conversation -7


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_awkward_rows_match_sql(spark, edge, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{edge}/{t}.parquet/*.parquet')")
    assert compare(QUERIES[name](spark, edge), con, ORACLE_SQL[name]) == []


def brute_passages(docs, length=50):
    where = collections.defaultdict(set)
    for d, t in docs:
        w = words_of(t)
        for i in range(len(w) - length + 1):
            where[tuple(w[i:i + length])].add(d)
    spans = set()
    for d, t in docs:
        w, last = words_of(t), None
        for i in range(len(w) - length + 1):
            if len(where[tuple(w[i:i + length])]) > 1:
                if last and i <= last[2]:
                    last[2] = i + length
                else:
                    if last:
                        spans.add(tuple(last))
                    last = [d, i, i + length]
        if last:
            spans.add(tuple(last))
    return spans


@pytest.mark.parametrize("where", ["edge", SF])
def test_passages_match_brute_force(spark, edge, where):
    folder = edge if where == "edge" else where
    docs = [(r["doc_id"], r["text"]) for r in table(spark, folder, "documents").collect() if r["doc_id"] is not None]
    rows = QUERIES["op1_passages"](spark, folder).collect()
    assert {(r["doc_id"], r["start"], r["end"]) for r in rows} == brute_passages(docs) and rows
    words = collections.defaultdict(list)
    for d, t in docs:
        words[d].append(words_of(t))
    for r in rows:  # the first document really shares a part of the span
        assert r["first_doc"] <= r["doc_id"] and r["n_words"] == r["end"] - r["start"]
        own = {tuple(w[i:i + 50]) for w in words[r["doc_id"]] for i in range(r["start"], r["end"] - 49)}
        assert any(tuple(w[i:i + 50]) in own for w in words[r["first_doc"]] for i in range(len(w) - 49))


def brute_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
    ones = [sum(xxhash.xxh64_intdigest(p, 42) >> b & 1 for p in parts) * 2 > len(parts) for b in range(64)]
    return sum(o << b for b, o in enumerate(ones))


def brute_components(ids, fps, bits=4):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    arr = np.array(fps, np.uint64)
    for i in range(len(arr)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1:] ^ arr[i]) <= bits) + i + 1:
            parent[find(i)] = find(int(j))
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return [low.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("where", ["edge", SF])
def test_simhash_matches_brute_force(spark, edge, where):
    folder = edge if where == "edge" else where
    docs = table(spark, folder, "documents").select("doc_id", "text").collect()
    fps = [brute_fingerprint(r["text"]) for r in docs]
    want = collections.Counter(zip([r["doc_id"] for r in docs], [f"{f:016x}" for f in fps],
                                   brute_components([r["doc_id"] for r in docs], fps)))
    got = QUERIES["op5_simhash"](spark, folder).collect()
    assert collections.Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want


@pytest.mark.parametrize("where", ["edge", SF])
def test_sentencepiece_matches_library(spark, edge, where):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=queries.model_path(queries.PIECE_MODEL))
    folder = edge if where == "edge" else where
    want = collections.Counter()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in table(spark, folder, "documents").collect():
        ids = sp.encode(r["text"] or "", add_eos=True)
        want[r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(sp.decode(ids))] += 1
    got = QUERIES["op6_sentencepiece"](spark, folder).collect()
    assert collections.Counter(tuple(r) for r in got) == want


def brute_neighbours(rows, k=20):
    rows = [(i, np.array(v, float)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    size = collections.Counter(len(v) for _, v in rows).most_common(1)[0][0]
    rows = [r for r in rows if len(r[1]) == size]
    ids, x = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    out = {}
    for q in {i for i in ids.tolist() if i % 20 == 0}:
        s = (x * x[np.flatnonzero(ids == q)[0]]).sum(1)
        other = np.flatnonzero(ids != q)
        out[q] = [(int(ids[i]), s[i]) for i in other[np.lexsort((ids[other], -s[other]))][:k]]
    return out


@pytest.mark.parametrize("where", ["edge", SF])
def test_neighbours_against_brute_force(spark, edge, where):
    folder = edge if where == "edge" else where
    want = brute_neighbours([(r["vec_id"], r["embedding"]) for r in table(spark, folder, "embeddings").collect()])
    got = collections.defaultdict(list)
    for r in sorted(QUERIES["op9_neighbours"](spark, folder).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert got.keys() == want.keys()
    hits = 0
    for q, rows in got.items():
        assert len(rows) == len(want[q])
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))
        hits += len({i for i, _ in rows} & {i for i, _ in want[q]})
        known = dict(want[q])
        assert all(abs(s - known[i]) < 1e-9 for i, s in rows if i in known)
    assert hits >= 0.9 * sum(map(len, want.values()))


def auc(score, label):
    score, label = np.array(score), np.array(label)
    pos, neg = score[label == 1], score[label == 0]
    return float(((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg)))


@pytest.mark.parametrize("name, label, folds, out, least", [("op4_quality", "quality", 5, 0, 0.97), ("op10_toxicity", "toxic", 4, 2, 0.75)])
def test_classifiers_on_held_out_rows(spark, name, label, folds, out, least):
    import zlib

    rows = {r["doc_id"]: r for r in QUERIES[name](spark, SF).collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % folds == out) for i, r in rows.items())
    known = [(rows[r["doc_id"]], r[label]) for r in table(spark, SF, "labels").collect()]
    held = [(r["score"], y) for r, y in known if r["held_out"]]
    assert auc(*zip(*held)) >= least


def test_main_text_of_pages(spark):
    """The article element's words, cut out by an independent rule of thumb."""
    import html
    import re

    want = {}
    for r in table(spark, SF, "pages").collect():
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r["html"], re.S).group(1)
        body = re.sub(r"<[^>]*>", "", re.sub(r"</?(?:p|h1|br)>", " ", body))
        want[r["page_id"]] = " ".join(html.unescape(body).split())
    got = QUERIES["op7_html"](spark, SF).collect()
    assert {r["page_id"]: r["text"] for r in got} == want
    assert all(r["n_chars"] == len(r["text"]) for r in got)
