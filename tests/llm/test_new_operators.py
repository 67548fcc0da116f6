"""The divergence audit, source mixing and fill-in-the-middle against brute force and round trips."""

import collections
import fractions
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import divergence, fim, mixing
from starloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def docs_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def test_translate_table_splits_like_the_pattern():
    import re
    rng = random.Random(1)
    pattern = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    for _ in range(300):
        text = "".join(rng.choice("aZ @[`{\x7f\x80\xa0\x85\u2028é漢😀0_\x00\n") for _ in range(30))
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        assert [t.decode() for t in text.encode().translate(divergence.TRANSLATE).split()] == pattern.findall(lowered)


def brute_audit(rows, min_docs, smooth, scale, top):
    counts, docs, groups = collections.defaultdict(collections.Counter), collections.Counter(), set()
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        words = [t.decode() for t in (text or "").encode().translate(divergence.TRANSLATE).split()]
        counts[lang, source].update(words)
        docs.update((lang, w) for w in set(words))
    out = set()
    for lang, source in groups:
        kept = sorted(w for (lg, w), n in docs.items() if lg == lang and n >= min_docs)
        share = {}
        for s in [s for lg, s in groups if lg == lang]:
            total = sum(counts[lang, s][w] for w in kept)
            share[s] = {w: 1 + scale * (counts[lang, s][w] + smooth) // (total + smooth * len(kept)) for w in kept}
        both = collections.Counter()
        for s in share:
            both.update({w: counts[lang, s][w] for w in kept})
        whole = {w: 1 + scale * (both[w] + smooth) // (sum(both.values()) + smooth * len(kept)) for w in kept}
        pairs = [(-sum(abs(share[source][w] - share[s][w]) for w in kept), s.encode()) for s in share if s != source]
        terms = [(whole[w] - share[source][w], w.encode()) for w in kept if counts[lang, source][w] and share[source][w] > whole[w]]
        for part, items in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
            out |= {(lang, source, part, i.decode(), -v, r) for r, (v, i) in enumerate(items, 1)}
    return out


@pytest.mark.parametrize("cells", [7, 100_000])
def test_audit_equals_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    monkeypatch.setattr(divergence, "TASK_ENTRIES", 20)
    rng = random.Random(2)
    words = ["Ab", "cd", "É", "漢字", "ef gh", "x1y", "Zz"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 20))), rng.choice(["en", "de", None, ""]),
             rng.choice(["a", "b", "c", None, "é"])) for i in range(150)]
    rows += [(1, None, "xx", "only"), (1, "", "yy", "p"), (1, "lone", "yy", "q"), *[(7, "Ab ab", "en", "a")] * 5]
    got = divergence.audit(docs_of(spark, rows), min_docs=4, smooth=5, scale=1000, top=3).collect()
    assert {tuple(r) for r in got} == brute_audit(rows, 4, 5, 1000, 3) and len(got) == len(set(map(tuple, got)))


def brute_targets(sizes, weights=(3, 1, 2), share=fractions.Fraction(3, 2)):
    """The contract's words: share by weight, cut at twice the size, share the excess again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    target, capped = dict.fromkeys(names, fractions.Fraction(0)), set()
    while True:
        left = share * sum(sizes.values()) - sum(target[s] for s in capped)
        free = [s for s in names if s not in capped]
        for s in free:
            target[s] = left * weight[s] / sum(weight[f] for f in free)
        over = [s for s in free if target[s] > 2 * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = fractions.Fraction(2 * sizes[s])
            capped.add(s)


def test_targets_and_taken(spark):
    rng = random.Random(3)
    rows = []
    for i, (source, n) in enumerate({"b": 400, "a": 5, "é": 60, None: 90, "": 30, "none": 3}.items()):
        for k in range(n):
            rows.append((1000 * i + k, " ".join("w" for _ in range(0 if source == "none" else rng.randint(0, 60))), "en", source))
    rows += [(5, "hot copy " * 30, "en", "hot")] * 900 + [(None, "no id", "en", "a"), (None, None, "en", "a")]
    got = mixing.mix(docs_of(spark, rows), spans=True).collect()
    assert len(got) == len(rows)
    sizes = collections.Counter()
    for _, text, _, source in rows:
        sizes[source] += len((text or "").split())
    want, taken = brute_targets(sizes), collections.Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(float(want[r["source"]]), rel=1e-12)
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert sum((s["end"] - s["start"]) * s["times"] for s in r["spans"]) == r["taken"]
        assert all(0 <= s["start"] < s["end"] <= r["size"] for s in r["spans"])
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(2, t / 100)
    again = mixing.mix(docs_of(spark, rows).repartition(7).orderBy(F.rand(1)), spans=True).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))                       # reruns agree
    other = mixing.mix(docs_of(spark, rows), seed=2).collect()
    assert sorted((str(r["doc_id"]), r["taken"]) for r in other) != sorted((str(r["doc_id"]), r["taken"]) for r in got)


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 999])
def test_apportionment_gives_the_highest_quotients(spark, seats):
    rng = random.Random(seats)
    votes = [("g", i, rng.choice([0, 1, 2, 3, 50, 1000]) * 1.0, rng.choice([3, 10_000])) for i in range(30)] + [("h", 0, 5.0, 10_000)]
    df = spark.createDataFrame(votes, "g string, p int, v double, cap long").withColumn("seats", F.lit(seats).cast("long"))
    got = {(r["g"], r["p"]): r["quota"] for r in mixing.apportion(df, "g", "p", "v", "seats", "cap").collect()}
    for g in ("g", "h"):
        some = [(v, p, cap) for name, p, v, cap in votes if name == g]
        best = sorted((-v / (2 * k + 1), p, k) for v, p, cap in some if v for k in range(min(cap, seats)))[:seats]
        want = collections.Counter(p for _, p, _ in best)
        assert {p: got[g, p] for _, p, _ in some} == {p: want[p] for _, p, _ in some}


def test_shards_split_a_source(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 500)
    monkeypatch.setattr(mixing, "CHUNK_COPIES", 10)
    rows = [(i, "a b c d e f g h i j", "en", "s") for i in range(600)] + [(9999, "z z z z", "en", "s")] * 300 + [(i, "k l", "en", "t") for i in range(900)]
    got = mixing.mix(docs_of(spark, rows)).collect()
    for s in ("s", "t"):
        mine = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in mine) - mine[0]["target"]) <= mine[0]["target"] / 50
        assert all(r["taken"] <= 2 * r["size"] for r in mine)


def test_exception_index_converts_both_ways():
    rng = random.Random(4)
    for _ in range(200):
        text = "".join(rng.choice("ab \né漢😀\x7f\u07ff\uffff") for _ in range(rng.randint(0, 40)))
        data = np.frombuffer(text.encode(), np.uint8)
        index = fim.ExceptionIndex(data)
        chars = np.arange(len(text) + 1)
        places = np.array([len(text[:i].encode()) for i in chars])
        assert (index.to_bytes(chars) == places).all() and (index.to_chars(places) == chars).all()
        assert len(index.at) == sum(ord(c) > 127 for c in text)                   # ASCII spans need no entry


@pytest.mark.parametrize("unit", ["token", "char"])
def test_fim_round_trip(spark, unit):
    import re
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(["word", "é", "漢", "😀", " ", "\n", "<", "<P", "S>", "M>", "<S", "0"]) for _ in range(rng.randint(0, 30))), "", "")
            for i in range(800)] + [(900, None, "", ""), (901, "", "", ""), (None, "x y", "", ""), (902, "a <M> b", "", ""), (903, "w " * 90000, "", "")]
    made = fim.transform(docs_of(spark, rows), unit=unit)
    got = made.withColumn("back", fim.restored(F.col("output"), F.col("form"))).collect()
    texts = collections.defaultdict(list)
    for i, t, _, _ in rows:
        texts[i].append(t or "")
    forms = collections.Counter(r["form"] for r in got)
    assert min(forms[f] for f in ("plain", "psm", "spm")) > 20
    for r in got:
        text = texts[r["doc_id"]][0]
        assert r["back"] == text
        assert r["n"] == (len(re.findall("[A-Za-z]+|[^A-Za-z]", text)) if unit == "token" else len(text))
        if r["form"] == "plain":
            assert r["output"] == text and r["prefix_chars"] is None
        else:
            a, b = r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]
            p, m, s = text[:a], text[a:b], text[b:]
            assert r["output"] == ("<P>" + p + "<S>" + s + "<M>" + m if r["form"] == "psm" else "<S>" + s + "<P>" + p + "<M>" + m)
            if unit == "token":
                for cut in (a, b):                                                  # no word is cut
                    assert not (0 < cut < len(text) and re.fullmatch("[A-Za-z]{2}", text[cut - 1:cut + 1]))
    if unit == "token":
        assert forms["plain"] < len(rows) / 2


def test_fim_spans_batches_alike(spark, monkeypatch):
    want = sorted(map(str, QUERIES["op13_fim"](spark, SF).collect()))
    monkeypatch.setattr(fim, "BATCH_CHARS", 3000)
    assert sorted(map(str, QUERIES["op13_fim"](spark, SF).collect())) == want
