"""The operators' parts against naive versions, and their general interfaces."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm import chat, decontaminate, golay, html_text, neighbours, quality, secrets, simhash, toxicity
from starloom.llm.components import connected_components
from starloom.llm.fm_index import FMIndex, suffix_array


def test_suffix_array_and_search_match_naive():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n, top = int(rng.integers(5, 300)), int(rng.integers(1, 6))
        text = rng.integers(0, top + 1, n)
        text[-1] = 0
        number = {p: k for k, p in enumerate(np.flatnonzero(text == 0).tolist())}

        def suffix(i, text=text, number=number):
            stop = next(j for j in range(i, len(text)) if text[j] == 0)
            return [x + len(number) for x in text[i:stop].tolist()] + [number[stop]]

        assert suffix_array(text).tolist() == sorted(range(n), key=suffix)
        index = FMIndex(text, top)
        for size in (1, 2, 3):
            patterns = np.array(list(itertools.product(range(1, top + 1), repeat=size)))
            which, lo, hi = index.search(patterns)
            found = {tuple(patterns[w]): sorted(index.locate(np.arange(a, b)).tolist()) for w, a, b in zip(which, lo, hi)}
            want = {}
            for p in map(tuple, patterns.tolist()):
                at = [i for i in range(n - size + 1) if tuple(text[i:i + size].tolist()) == p]
                if at:
                    want[p] = at
            assert found == want


def test_golay_keys_meet_within_two_bits():
    words = np.random.default_rng(1).integers(0, 1 << 23, 500).astype(np.uint32)

    def sets(x):
        index, fresh = golay.keys(x)
        return [set(i[f].tolist()) for i, f in zip(index, fresh)]

    base = sets(words)
    assert {len(s) for s in base} <= {1, 6}
    for bits in [(), *itertools.combinations(range(23), 1), *itertools.combinations(range(23), 2)]:
        error = np.uint32(sum(1 << b for b in bits))
        assert all(a & b for a, b in zip(base, sets(words ^ error)))


def test_candidate_keys_meet_within_four_bits():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1 << 63, 300).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 300).astype(np.uint64)

    def sets(v):
        row, key = simhash.candidate_keys(v)
        out = [set() for _ in v]
        for r, k in zip(row, key):
            out[r].add(int(k))
        return out

    base = sets(x)
    for bits in range(5):
        y = x.copy()
        for i in range(len(y)):
            for b in rng.choice(64, bits, replace=False):
                y[i] ^= np.uint64(1) << np.uint64(b)
        assert all(a & b for a, b in zip(base, sets(y)))


@pytest.mark.parametrize("bucket", [20_000, 6])
def test_links_of_a_dense_group_are_complete(spark, bucket):
    """A large group of near fingerprints, also when every key is over the bucket size."""
    rng = random.Random(4)
    centre = rng.getrandbits(64)
    fps = {centre}
    while len(fps) < 120:
        f = centre
        for b in rng.sample(range(64), rng.randint(0, 9)):
            f ^= 1 << b
        fps.add(f)
    fps = sorted(fps | {rng.getrandbits(64) for _ in range(50)})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), 4, bucket)
    pairs = {(r["a"], r["b"]) for r in found.collect()}
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 4 for a, b in pairs)
    comp = {r["node"]: r["component"] for r in connected_components(found).collect()}
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(signed, 2):
        if ((a ^ b) & (1 << 64) - 1).bit_count() <= 4:
            parent[find(a)] = find(b)
    groups = {}
    for f in signed:
        groups.setdefault(find(f), set()).add(f)
    for g in groups.values():
        assert {comp.get(f, f) for f in g} == {min(g)} or len(g) == 1


def test_connected_components_of_chains_and_stars(spark):
    rows = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5, 5), (None, 7), (7, None), (3, 2), (2, 3)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1100), 1000)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_keep_one_row_of_each_group(spark):
    rows = [(1, "a b c d e f", "x"), (1, "a b c d e f", "x"), (2, "a b c d e f", "y"), (None, "q w e r t y", "z"),
            (None, "q w e r t y", "z"), (5, None, "n"), (7, "", "n"), (8, "other words are in here now", "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    assert sorted((str(r["doc_id"]), r["fp"]) for r in got.collect()) == [("1", "x"), ("5", "n"), ("8", "m"), ("None", "z")]


def test_cut_text_has_no_window_left(spark):
    item = " ".join(f"w{i}" for i in range(14))
    inner = "Before, w0 w1 w2 w3 w4 " + item + " w5 w6 w7 w8 w9 w10! After"
    docs = spark.createDataFrame([(1, inner, 0), (2, "clean text.", 11), (3, None, None)], "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, item), (2, "zz")], "item_id long, text string")
    got = {r["doc_id"]: r for r in decontaminate.remove_spans(docs, bench).collect()}
    assert got[2]["text"] == "clean text." and got[3]["text"] is None
    assert got[1]["text"] == "Before, ! After" and got[1]["n_chars"] == len(got[1]["text"])


@pytest.mark.parametrize("limit", [8_000_000, 40])
def test_benchmark_blocks_give_the_same_hits(spark, edge, limit):
    from starloom.llm.common import table

    docs, bench = table(spark, edge, "documents"), table(spark, edge, "benchmark")
    want = sorted(map(str, decontaminate.hit_digests(decontaminate.find_hits(docs, bench)).collect()))
    got = decontaminate.hit_digests(decontaminate.find_hits(docs, bench, block_bytes=limit))
    assert sorted(map(str, got.collect())) == want


def test_benchmark_blocks_cut_the_same_spans(spark):
    w = [f"w{i}" for i in range(1, 16)]
    # of the third text the cut of item 3 brings a window of item 1 together
    texts = [" ".join(w), "a " + " ".join(w) + " z", "a " + " ".join(w[:5]) + " xx yy " + " ".join(w[5:10]) + " z", None, "clean"]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    bench = spark.createDataFrame([(1, " ".join(w[:10])), (2, " ".join(w[5:])), (3, "xx yy")], "item_id long, text string").coalesce(1)
    want = sorted(map(str, decontaminate.remove_spans(docs, bench).collect()))
    got = decontaminate.remove_spans(docs, bench, block_bytes=40).collect()
    assert sorted(map(str, got)) == want
    assert [r["text"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["", "a  z", "a  z", None, "clean"]


def test_ledger_scans_unseen_pairs_only(spark, scratch):
    kind = "doc_id string, text string"
    key = "api_key=abcdef12345"
    one = secrets.content_address(spark.createDataFrame([("a", key), ("b", key), ("c", "nothing")], kind))
    folder = f"{scratch}/ledger"
    got = {r["path"]: r["spans"] for r in secrets.load_increment(one, folder).collect()}
    assert [s["rule"] for s in got["a"]] == ["assign"] and got["a"] == got["b"] and got["c"] == []
    assert spark.read.parquet(folder).count() == 2
    # nothing new: nothing is scanned
    secrets.load_increment(one, folder)
    assert spark.read.parquet(folder).count() == 2
    # a moved copy and a new version: one new blob; then a new rule version scans every blob again, for that rule
    two = secrets.content_address(spark.createDataFrame([("d", key), ("a", "AKIA" + "B" * 16)], kind))
    got = {r["path"]: [s["rule"] for s in r["spans"]] for r in secrets.load_increment(two, folder).collect()}
    assert got == {"d": ["assign"], "a": ["access"]}
    assert spark.read.parquet(folder).count() == 3
    newer = tuple(secrets.Rule(r.kind, 2, r.pattern, r.group, r.least) if r.kind == "hex" else r for r in secrets.RULES)
    fresh = secrets.scan(two, spark.read.parquet(folder), newer).collect()
    assert sorted(tuple(r["scanned"]) for r in fresh) == [("hex:2",), ("hex:2",)]


def test_ledger_drops_spans_of_old_rule_versions(spark, scratch):
    docs = spark.createDataFrame([("a", "token=abcdef99 deadbeefdeadbeefdeadbeef01"), ("b", "token=abcdef99"), (None, None)],
                                 "doc_id string, text string")
    folder, one = f"{scratch}/ledger", secrets.content_address(docs)
    kinds = lambda rows: {r["path"]: [(s["rule"], s["version"]) for s in r["spans"]] for r in rows.collect()}
    assert kinds(secrets.load_increment(one, folder)) == {"a": [("assign", 1), ("hex", 1)], "b": [("assign", 1)], None: []}
    nothing = tuple(secrets.Rule("assign", 2, "(?!x)x", 0, 1) if r.kind == "assign" else r for r in secrets.RULES)
    assert kinds(secrets.load_increment(one, folder, nothing)) == {"a": [("hex", 1)], "b": [], None: []}
    # a second delivery: only the blob that is new is scanned, with every rule
    more = secrets.content_address(docs.unionByName(spark.createDataFrame([("c", "token=abcdef99"), ("d", "secret: zzzzzz")], docs.schema)))
    before = spark.read.parquet(folder)
    fresh = secrets.scan(more, before, nothing).collect()
    assert [sorted(r["scanned"]) for r in fresh] == [["access:1", "assign:2", "hex:1"]]
    assert kinds(secrets.load_increment(more, folder))["c"] == [("assign", 1)]     # the older rule again: its blob was scanned with it
    # the query's way: a ledger that stays serves the next call without a scan
    found = secrets.scan_documents(docs, folder)
    assert found.count() == 3 and spark.read.parquet(folder).where("size(scanned) = 0").count() == 0


def test_redacted_text_has_no_secret(spark):
    docs = spark.createDataFrame([(1, "é key token=abcdef99 and AKIA" + "C" * 16 + " end", 0, "blob"), (2, None, None, "x"), (3, "ok", 2, "y")],
                                 "doc_id long, text string, n_chars long, blob string")
    got = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert got[1]["text"] == "é key [SECRET] and [SECRET] end" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] is None and got[3]["text"] == "ok" and got[3]["n_chars"] == 2


def test_escaping_is_reversible(spark):
    rng = random.Random(5)
    parts = ["<", ">", "/", "s", "\\", "[", "]", "INST", "|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "n", "\n", " "]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(2000)]
    x = F.col("x")
    got = spark.createDataFrame([(t,) for t in texts], "x string").select(
        "x", chat.escape(x).alias("e"), chat.unescape(chat.escape(x)).alias("u"),
        chat.escape_role(x).alias("r"), chat.unescape_role(chat.escape_role(x)).alias("v")).collect()
    assert all(r["x"] == r["u"] == r["v"] and "\n" not in r["r"] for r in got)
    assert not any(c in r["e"] for r in got for c in ("<s>", "</s>", "[INST]", "[/INST]", "<|", "<<SYS>>", "<</SYS>>"))


@pytest.mark.parametrize("system", ["x" * 40, None, "s" * 1000, "s" * 6016])
def test_chat_windows_hold_the_budget(spark, system):
    """``sum <= budget`` with the system turn, history and own turns, unless one own turn can't fit."""
    roles = [("system" if i == 0 and system else ("user", "assistant")[i % 2]) for i in range(2000)]
    rows = [(1, i, r, system if r == "system" else "x" * (40 + i % 90) if i % 97 else "long " * 500) for i, r in enumerate(roles)]
    rows += [(2, 7, "user", "y" * (i % 200)) for i in range(1500)]        # one turn number for all
    conv = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = chat.windows(conv, budget=300, history=80).collect()
    size = lambda t: -(-len(t["text"]) // 4) + 4
    assert len(made) > 50
    repeated = 0
    for r in made:
        own = [t for t in r["turns"] if not t["repeated"]]
        again = [t for t in r["turns"] if t["repeated"] and t["role"] != "system"]
        told = [t for t in own if t["role"] != "system"]
        if r["conv_id"] == 1 and system:
            assert r["turns"][0]["role"] == "system"
        assert told and (sum(map(size, r["turns"])) <= 300 or len(told) == 1 and not again)
        assert sum(map(size, again)) <= 80
        assert not again or [t["pos"] for t in again] == list(range(told[0]["pos"] - len(again), told[0]["pos"]))
        assert [t["pos"] for t in r["turns"]] == sorted(t["pos"] for t in r["turns"])
        repeated += len(again)
    assert repeated > 20
    for c, n in ((1, 2000), (2, 1500)):
        assert sorted(t["pos"] for r in made if r["conv_id"] == c for t in r["turns"] if not t["repeated"]) == list(range(1, n + 1))
    # a block's edge cuts off no history
    edge = [r for r in made if r["conv_id"] == 2 and any(t["pos"] == 513 and not t["repeated"] for t in r["turns"])]
    assert any(t["pos"] == 512 and t["repeated"] for t in edge[0]["turns"])


def test_pairwise_part_equals_the_double_sum():
    rng = np.random.default_rng(6)
    model = quality.FactorisationMachine(30, 4)
    model.v = rng.standard_normal((30, 4)).astype(np.float32)
    model.w = rng.standard_normal(30).astype(np.float32)
    rows = [(rng.choice(30, n, replace=False).astype(np.int32), rng.standard_normal(n).astype(np.float32)) for n in (1, 5, 12)]
    z, _ = model.parts(*quality.flat(rows))
    for (at, x), got in zip(rows, z):
        want = sum(model.w[at] * x) + sum(model.v[at[i]] @ model.v[at[j]] * x[i] * x[j]
                                          for i in range(len(at)) for j in range(i))
        assert abs(want - got) < 1e-3


def repeated_ids():
    """Clean and toxic ids of one row each, and a clean id with many rows, some of them equal."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["ba", "do", "ke", "li", "mo", "ru", "ta"]) for _ in range(rng.randint(2, 6)))
    text = lambda *more: " ".join([word() for _ in range(30)] + list(more))
    docs = [(i, text("idiot") if i % 2 else text()) for i in range(120)] + [(1000, text()) for _ in range(200)]
    labels = [(i, i % 2, i % 2) for i in range(120)] + [(1000, 0, 0)]
    return docs + docs[-3:] * 40, labels


def test_training_sample_has_every_id_within_the_bound(spark):
    from starloom.llm.common import training_texts

    docs, labels = repeated_ids()
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = training_texts(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "toxic", (1, 1), 150)
    keys = {(r["doc_id"], r["text"]) for r in got.collect()}
    assert len(keys) == 150 and {i for i, _ in keys} == {i for i, _, _ in labels}


def test_repeated_ids_push_no_toxic_row_out_of_the_calibration(spark, monkeypatch):
    docs, labels = repeated_ids()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    seen, logistic = [], toxicity.logistic
    monkeypatch.setattr(toxicity, "logistic", lambda x, y: seen.append(y) or logistic(x, y))
    toxicity.fit(frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), fold=(1, 1), rows=150)
    assert len(seen[0]) == 150 and seen[0].sum() == 60


def test_kernel_counts_common_subsequences():
    of = toxicity.Subsequences()

    def naive(a, b):
        def feats(u):
            out, norm = {}, 0.0
            for i, j, k in itertools.combinations(range(len(u)), 3):
                if k - i < toxicity.SPAN:
                    w = toxicity.DECAY ** (k - i + 1)
                    out[u[i], u[j], u[k]] = out.get((u[i], u[j], u[k]), 0) + w
                    norm += w * w
            return out, norm ** 0.5
        (x, nx), (y, ny) = feats(a), feats(b)
        return sum(v * y.get(c, 0) for c, v in x.items()) / (nx * ny) if nx and ny else 0.0

    units = ["idiot", "i.d.iot", "banana", "ab", "idiotic"]
    got = of.kernel(units, ["idiot", "banana"])
    assert np.allclose(got, [[naive(u, z) for z in ("idiot", "banana")] for u in units], atol=1e-5)


def test_svm_tolerates_inserted_characters():
    rng = random.Random(7)
    clean = {"".join(rng.choice(["ba", "do", "ke", "li", "mo", "ru", "ta"]) for _ in range(rng.randint(2, 5))): 3 for _ in range(400)}
    weights, bias = toxicity.train_units({"stupid": 30, "idiot": 25, "moron": 20, "worthless": 20}, clean)
    score = toxicity.Scorer(weights, bias)
    bad = ["stupid", "idiot", "st.upid", "stu*pid", "id-iot", "idioot", "worthlesss", "mo_ron"]
    assert (score.margins(bad) > 0).all()
    assert (score.margins(list(clean)) < 0).mean() > 0.98
    texts = ["bado keli. you w o r t h l e s s tamo.", "bado keli. you are tamo.", None, ""]
    best = score.summaries(texts)[:, 0]
    assert best[0] > 0 and (best[1:] < 0).all()


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<p>a &amp; b", "a & b"), ("<script>x<p>", ""), ("a<b>b</b> c", "ab c"),
    ("<body><header><h1>Site</h1></header><div class='cookie-notice'>We use cookies</div><main><h2>Title</h2><p>Text  one\n two.</p>"
     "<form><label>mail</label></form><div class='advert'>Buy</div><p>Three.</p></main><div id='sidebar'>side</div>"
     "<section id='comments'><p>Reader says</p></section><footer>f</footer>", "Title Text one two. Three."),
    ("<div><div class='content'>" + "<p>Words of the text are here and there.</p>" * 5 + "</div><ul><li><a href=x>l1</a><li><a href=y>l2</a></ul></div>",
     " ".join(["Words of the text are here and there."] * 5)),
])
def test_main_text(page, text):
    assert html_text.main_text(page) == text


LONG = "<p>Words of the text are here and there, and many more of them follow.</p>" * 6
SAID = " ".join(["Words of the text are here and there, and many more of them follow."] * 6)


@pytest.mark.parametrize("page, text", [
    ("<html><head><title>T</title><meta name=x><body>" + LONG + "</body></html>", SAID),
    ("<html><head><title>T</title>" + LONG, SAID),
    ("<div><button>Menu</div>" + LONG, SAID), ("<button>Menu" + LONG, SAID), ("<div><select><option>A<option>B</div>" + LONG, SAID),
    ("<object data=x>" + LONG, SAID), (LONG + "<button><div>Menu</div></button><select><option>A<option>B</select>", SAID),
    ("<div class='content no-sidebar'><article>" + LONG + "</article><div class='sidebar'>side</div></div>", SAID),
    ("<div class='has-header-image'>" + LONG + "</div><div class='promo'>Buy</div>", SAID),
    ("<nav>menu</nav><article class='post category-social'>" + LONG + "</article><div id='comments'><article class='comment'>"
     + "<p>A reader has much to say about this text.</p>" * 30 + "</article></div>", SAID),
    ("<form id='aspnetForm'><nav><a href=x>menu</a></nav>" + LONG + "</form>", SAID), ("<aside>" + LONG + "</aside>", SAID),
    ("<nav><a href=x>menu</a></nav><p hidden>secret</p>", ""),
    ("<div class='ad'>Buy this and that, and more of it.</div><article><h1>Short.</h1></article>", "Short."),
])
def test_main_text_is_not_lost_to_marks_and_open_elements(page, text):
    assert html_text.main_text(page) == text


ITEMS = [f"Item {i} of the list is a sentence of some words, like the others." for i in range(40)]


@pytest.mark.parametrize("page, text", [
    ("<nav><a href=x>menu</a></nav><div><p>These words come before the list that follows them.</p><ul>"
     + "".join(f"<li>{x}" for x in ITEMS) + "</ul><p>These words come behind the list.</p></div><footer>foot</footer>",
     " ".join(["These words come before the list that follows them.", *ITEMS, "These words come behind the list."])),
    ("<table><tr><td><blockquote>" + "".join(f"<p>{x}</p>" for x in ITEMS) + "</blockquote></td></tr></table><p>Short end.</p>",
     " ".join([*ITEMS, "Short end."])),
    ("<article>" + LONG + "</article><article>" + LONG + "</article>", SAID + " " + SAID),
    ("<article>" + LONG * 9 + "</article><article><p>Brief.</p></article>", " ".join([SAID] * 9 + ["Brief."])),
    ("<div><p>A standfirst says in some words what the whole text is about.</p></div><div><article>" + LONG + "</article></div>",
     "A standfirst says in some words what the whole text is about. " + SAID),
    ("<div><div><h1>A headline over it</h1></div><div>" + LONG + "</div></div>", "A headline over it " + SAID),
])
def test_main_text_has_all_content(page, text):
    assert html_text.main_text(page) == text


def test_small_blocks_find_the_same_neighbours(spark, edge):
    from starloom.llm.common import table

    emb = table(spark, edge, "embeddings")
    few = neighbours.search(emb, F.col("vec_id") % 20 == 0, 5, block_vectors=40, block_queries=7, verify=1.0).collect()
    one = neighbours.search(emb, F.col("vec_id") % 20 == 0, 5, verify=1.0).collect()
    assert sorted(map(str, few)) == sorted(map(str, one))


def article(inside, after=""):
    return (f"<html><body><nav><a href=x>menu</a></nav><article><h1>Title</h1><p>{'word text here ' * 30}</p>{inside}"
            f"<p>{'more text there ' * 30}</p></article>{after}<footer>foot</footer></body></html>")


@pytest.mark.parametrize("block,text", [
    ('<h2 id="related-work">Related work</h2>', "Related work"),
    ('<p class="share-note">Please note this share of it.</p>', "Please note this share of it."),
    ('<div class="search-results-explained"><p>We explain the results.</p></div>', "We explain the results."),
    ('<div class="commentary"><p>Our own commentary.</p></div>', "Our own commentary."),
    ('<header><h2>A second head</h2></header>', "A second head")])
def test_html_keeps_article_blocks_whose_names_hold_a_mark(block, text):
    from starloom.llm.html_text import main_text
    whole = main_text(article(block))
    assert text in whole and whole.startswith("Title word") and "menu" not in whole and "foot" not in whole


@pytest.mark.parametrize("block", [
    '<div class="ad-slot">Gone now</div>', '<div class="comments"><p>' + "Gone, I liked it " * 20 + "</p></div>",
    '<div class="comment-thread-x"><p>' + "Gone, I liked it " * 20 + "</p></div>",
    '<div class="related-posts-here"><a href=a>Gone one</a> <a href=b>Gone two</a></div>',
    '<ul class="share"><li><a href=x>Gone</a></ul>', "<div class=newsletter>Gone with our letter</div>", "<aside>Gone</aside>"])
def test_html_leaves_out_parts_of_an_article_that_are_no_text(block):
    from starloom.llm.html_text import main_text
    assert "Gone" not in main_text(article(block)) and "more text" in main_text(article(block))


def test_html_leaves_out_a_long_legal_notice():
    from starloom.llm.html_text import main_text
    assert "reserved" not in main_text(article("", "<div class=legal>" + "all rights are reserved by us " * 20 + "</div>"))


@pytest.mark.parametrize("html", ["<a " * 350000, "<!--" * 250000, "<div>" * 200000 + "x", "<div>" * 90000 + "x" + "</div>" * 80000,
                                  '<a href="' * 110000 + ">", "<" * 1000000, "</" * 500000, "<![CDATA[" * 110000,
                                  "<div>" * 100000 + "</nav>" * 80000, "<p><li>" * 140000, "<title>" * 140000])
def test_html_of_a_megabyte_takes_seconds(html):
    import time

    from starloom.llm.html_text import main_text
    start = time.process_time()
    main_text(html)
    assert time.process_time() - start < 30
