"""Language identification, decontamination and the two classifiers."""

import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from brackish.llm import decontam, labels, langid, pages, quality, queries, toxicity
from brackish.llm.texts import fold
from tests.llm import brute
from tests.oracle import compare

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").cache()


def test_language_of_held_out_documents(spark, docs):
    found = queries.QUERIES["op1_language_id"](spark, FOLDER)
    rows = found.where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert found.count() == docs.count() and np.mean([r.lang == r.lang_pred for r in rows]) >= 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_texts(spark, docs):
    profiles = langid.fit_profiles(docs.where(fold(F.col("doc_id"), 4) != 2))
    odd = [(1, None, "x"), (2, "", "x"), (3, "12 + 3 = 15 !!", "x"), (None, "und der die das ist nicht", "x"), (4, "und der die das ist nicht " * 200_000, "x")]
    got = langid.identify(spark.createDataFrame(odd, "doc_id long, text string, SCORE string"), profiles).collect()
    assert {r.doc_id: r.lang_pred for r in got} == {1: "und", 2: "und", 3: "und", None: "de", 4: "de"}
    assert [r.score for r in got if r.lang_pred == "und"] == [0.0] * 3
    nothing = langid.fit_profiles(docs.limit(0))
    assert {r.lang_pred for r in langid.identify(docs.limit(3), nothing).collect()} == {"und"}


def test_out_of_place_distance_by_hand():
    values, counts = langid.ngrams("Ab ab".encode())
    at = dict(zip(values.tolist(), counts.tolist(), strict=True))
    code = lambda *c: sum(ord(x) << 21 * i for i, x in enumerate(c))
    assert at == {code("a"): 2, code("b"): 2, code(" ", "a"): 2, code("a", "b"): 2, code("b", " "): 2, code(" ", "a", "b"): 2, code("a", "b", " "): 2}
    _, places = langid.ranked(np.array([5, 6, 7, 8]), np.array([3, 9, 3, 1]), 3)
    assert places.tolist() == [0.0, 1.5, 1.5]


ITEM = "A train leaves Boston at 3 pm and travels 120 km to reach Salem in 2.5 hours, then Boston calls it back home again."


def test_reparameterised_questions(spark):
    docs = [
        (1, "Intro. " + ITEM.replace("Boston", "Dover").replace("3 pm", "7 pm").replace("120", "55") + " End."),  # consistent
        (2, "Intro. " + ITEM.replace("Boston at", "Dover at") + " End."),  # Boston becomes two names
        (3, "see " + ITEM.lower()), (4, None), (5, ""), (6, ITEM), (6, ITEM), (None, ITEM), (7, "A train leaves at noon. " * 50),
        (8, "1 2 3 4 5 6 7 8 9 10 " * 100), (9, "Short item here now yes"),
    ]
    items = [(1, ITEM), (2, "Short item here now yes"), (3, None), (4, ""), (5, "1 2 3 4 5 6 7 8"), (None, "one two three four five six")]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, form int")
    got = decontam.contaminated(df, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.exact) for r in got} == {(1, 1, False), (6, 1, True), (9, 2, True)}
    assert {r.doc_id for r in decontam.clean(df, spark.createDataFrame(items, "item_id long, text string")).collect()} == {2, 3, 4, 5, 7, 8, None}


def test_contamination_against_brute_force(spark, docs):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    want = brute.contaminated([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert got == want and len(got) > 10
    assert decontam.contaminated(docs.limit(0), items).count() == 0
    assert decontam.contaminated(docs, items.limit(0)).count() == 0


def test_many_benchmark_windows_are_joined_by_shuffle(spark, docs, monkeypatch):
    items = spark.read.parquet(f"{FOLDER}/benchmark.parquet")
    few = {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()}
    monkeypatch.setattr(decontam, "BROADCAST_WINDOWS", 0)
    assert {(r.doc_id, r.item_id) for r in decontam.contaminated(docs, items).collect()} == few


@pytest.mark.parametrize("name, label, least", [("op9_quality", "quality", 0.95), ("op3_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = queries.QUERIES[name](spark, FOLDER)
    rows = got.where("held_out").join(marks, "doc_id").collect()
    assert np.mean([r.predicted == r[label] for r in rows]) >= least
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
    ones, zeros = ([r.score for r in rows if r[label] == v] for v in (1, 0))
    assert np.mean(ones) > np.mean(zeros) + 0.3


@pytest.mark.parametrize("model", [quality, toxicity])
def test_classifiers_on_odd_texts_and_labels(spark, docs, model):
    marks = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col("quality" if model is quality else "toxic").alias("y"))
    marks = marks.union(spark.createDataFrame([(None, 1), (1, None), (10**9, 1)], "doc_id long, y int"))
    fitted = model.fit(docs, marks, "y", train_docs=60)
    odd = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "a", 1), (None, "x " * 3_000_00, 1)], "doc_id long, text string, Score int")
    got = model.score(odd, fitted).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert model.fit(docs, marks.limit(0), "y") == 0.0
    assert model.fit(docs, marks.where("y = 1"), "y") == 1.0
    assert model.score(docs.limit(0), fitted).count() == 0


def test_sample_is_bounded(spark, docs):
    marks = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("y"))
    texts, found, share = labels.labelled_sample(docs, marks, "y", 25)
    assert len(texts) == 50 and sorted(found.tolist()) == [0] * 25 + [1] * 25 and 0.4 < share < 0.6


def test_gradient_of_the_network():
    random = np.random.default_rng(0)
    net = quality.train([b"good text here " * 20, b"### bad !! " * 20] * 10, np.array([1, 0] * 10))
    rows = random.integers(1, 255, (3, quality.CHUNK)).astype(np.uint8)
    target, weight = np.array([1, 0, 1], np.float32), np.ones(3, np.float32)

    def loss():
        z = net.logits(rows).astype(float)
        return float(np.mean(np.log1p(np.exp(-z)) * target + np.log1p(np.exp(z)) * (1 - target)))

    found = quality._gradient(net, rows, target, weight)
    for name, at in (("bias", (3,)), ("largest", (5,)), ("mean", (2,)), ("first", (9, 4)), ("second", (20, 7)), ("base", (0,)), ("embed", (int(rows[0, 40]), 2))):
        array = getattr(net, name)
        kept, step = array[at], 1e-2
        array[at] = kept + step
        up = loss()
        array[at] = kept - step
        down = loss()
        array[at] = kept
        assert abs((up - down) / (2 * step) - found[name][at]) < 2e-3 + 0.05 * abs(found[name][at])


PAGE = (
    "<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header class='site'><h1>Site</h1></header><nav><a>menu</a></nav>"
    "<div class='cookie-notice'>We use cookies</div>%s<form><input><button>Send</button></form><aside>side</aside>"
    "<div id='comments'><article><p>Nice!</p></article></div><footer>foot</footer>"
)


def test_lines_of_a_page():
    found = pages.lines(PAGE % "<article><h1>Head &amp; more</h1><p>First  para.<p>Second <b>bold</b><br>x<script>var a='</p>';</script> y<!-- c --></article>")
    assert [t for t, k in found if k != pages.FURNITURE] == ["Head & more", "First para.", "Second bold x y"]
    assert pages.lines("") == [] and pages.lines("<p") == [] and pages.lines("plain & simple") == [("plain & simple", pages.OPEN)]
    assert pages.lines("<div class=ad>ad<article><p>x</p></article>")[-1] == ("x", pages.ARTICLE)


def test_longest_common_lines():
    random = np.random.default_rng(1)
    for _ in range(60):
        a, b = ([str(x) for x in random.integers(0, 4, random.integers(0, 14))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        for most in (1 << 20, 5):
            found = sorted(pages.shared(a, b, most))
            rest = iter(b)
            assert len(found) == table[-1, -1] and all(a[i] in rest for i in found)


def test_pages_beside_each_other(spark):
    """Without an article element what neighbours share goes; versions of one page and lone pages keep their text."""
    page = lambda n: f"<body><div>Welcome to our site</div><div>Story {n} begins.</div><p>And it goes on {n}.</p><div>All rights kept</div></body>"
    rows = [(i, f"http://h.example/a/{i}?x=1", page(i)) for i in range(5)] + [(9, "http://other.example/z", page(9)), (10, None, None), (11, "http://h.example/b/1", "")]
    rows += [(20, "http://twin.example/t/1", page(20)), (21, "http://twin.example/t/1/", page(20)), (3, "http://h.example/a/3?x=1", page(3))]
    df = spark.createDataFrame([(*r, 5) for r in rows], "page_id long, url string, html string, N_CHARS int")
    got = pages.extract(df)
    assert got.columns == ["page_id", "url", "html", "text", "n_chars"]
    texts = [(r.page_id, r.text, r.n_chars) for r in got.collect()]
    assert len(texts) == len(rows)
    by = {i: t for i, t, _ in texts}
    assert by[1] == "Story 1 begins.\n\nAnd it goes on 1." and by[10] == by[11] == ""
    assert by[9].startswith("Welcome") and by[20] == by[21] and "Story 20" in by[20]
    assert all(n == len(t) for _, t, n in texts)
    assert pages.extract(df.limit(0)).count() == 0


def test_pages_as_reviewed(spark):
    """Body in blocks beside teasers; cards in closed furniture; a plain notice on every page; a short story under a long menu."""
    teaser = '<body><article><h2>Other story</h2><p>Teaser.</p></article><div>The body %s starts here.</div><div>It goes on for a good while.</div><article><p>More.</p></article></body>'
    related = '<body><article><p>Main text %s of the page.</p></article><div class="related"><article><p>A card %s.</p></article></div></body>'
    notice = '<body><article><p>Sign up for our daily letter.</p><p>Story %s is told.</p><p>%s</p></article></body>'
    menu = "<body>" + "".join(f"<div>Entry {i} of the menu</div>" for i in range(9)) + "<div>Short story %s.</div></body>"
    rows = [(i, f"http://a.example/{i}", teaser % i) for i in range(3)] + [(10 + i, f"http://b.example/{i}", related % (i, i)) for i in range(3)]
    rows += [(20 + i, f"http://c.example/{i}", notice % (i, "Quoted by two." if i < 2 else f"Own line {i}.")) for i in range(4)]
    rows += [(30 + i, f"http://d.example/{i}", menu % i) for i in range(3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    got = {r.page_id: r.text for r in pages.extract(df).collect()}
    assert all("The body" in got[i] and "Teaser" not in got[i] for i in range(3))
    assert [got[10 + i] for i in range(3)] == [f"Main text {i} of the page." for i in range(3)]
    assert [got[20 + i] for i in range(4)] == ["Story 0 is told.\n\nQuoted by two.", "Story 1 is told.\n\nQuoted by two.", "Story 2 is told.\n\nOwn line 2.", "Story 3 is told.\n\nOwn line 3."]
    assert [got[30 + i] for i in range(3)] == [f"Short story {i}." for i in range(3)]


def test_pages_of_any_order(spark):
    """All pages against plain loops: the two nearest other texts of the host by path, whatever the batches."""
    random = np.random.default_rng(4)
    rows = []
    for i in range(120):
        host, common = random.integers(0, 3), [f"<div>c{x}</div>" for x in random.integers(0, 6, 4)]
        own = [f"<p>own {i} {x}</p>" for x in range(random.integers(0, 4))]
        html = None if i % 17 == 0 else "" if i % 19 == 0 else "".join([*common[:2], *own, *common[2:]])
        rows.append((i, f"http://h{host}.example/p{random.integers(0, 30):02}", html))
    rows += [(200 + i, r[1], r[2]) for i, r in enumerate(rows[:10])] + [rows[3]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = sorted((r.page_id, r.text) for r in pages.extract(df.repartition(1)).coalesce(1).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    found = [pages.outline(h or "") for _, _, h in order]
    want = []
    for n, (i, url, _) in enumerate(order):
        sides = []
        for step in (-1, 1):
            side, at = [], n + step
            while 0 <= at < len(order) and order[at][1].split("/")[2] == url.split("/")[2] and len(side) < 2:
                texts = [t for t, _, _ in found[at]]
                if texts and texts != [t for t, _, _ in found[n]] and texts not in side:
                    side.append(texts)
                at += step
            sides.append(side)
        a, b = sides
        want.append((i, pages.main_text(found[n], a[:1] + b[:1] if a and b else a + b)))
    assert sum(x != y for x, y in zip(got, sorted(want), strict=True)) <= len(rows) // 20  # borders of ranges


def test_hostile_pages_take_linear_time():
    for page in ('<a "x ' * 60_000, "<div>" * 40_000 + "</span></p>" * 40_000, "<i><div>" + "<b>" * 30_000 + "</i>" * 30_000, "<a '\">" * 50_000, "<" * 500_000, "<x a='>" * 60_000, "<div class=ad><article>" * 20_000):
        start = time.perf_counter()
        pages.lines(page)
        assert time.perf_counter() - start < 8


def test_items_with_letters_behind_dots(spark, tmp_path):
    """A letter behind a dot or a comma is cut alike before and after the first pass, and as in SQL."""
    words = "we ask which of the given seven options holds at noon in every large town near here"
    items = [(n, words.replace("options", w) + f" part{'abcde'[n]}") for n, w in enumerate(["e.g. options", "U.S. options", "np.sum", "yes,no", "nine a.m. options"])]
    texts = [(n, f"Before it. {t}. And after it.") for n, t in items] + [(9, "Nothing of it. " * 20)]
    for name, key, rows in (("documents", "doc_id", texts), ("benchmark", "item_id", items)):
        spark.createDataFrame(rows, f"{key} long, text string").write.parquet(f"{tmp_path}/{name}.parquet")
    got = queries.QUERIES["op2_decontam"](spark, str(tmp_path))
    assert {(n, n) for n, _ in items} <= {(r.doc_id, r.item_id) for r in got.collect()}
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert compare(got.toArrow(), con.execute(queries.ORACLES["op2_decontam"]).to_arrow_table()) == []


def test_items_in_other_case_and_inside_a_sentence(spark, tmp_path):
    """The pipeline stage finds exact copies of any case, and changed ones behind other words."""
    long = "Every farmer near the river sells fresh apples to Boston traders each autumn"  # 13 tokens
    short = "Seven old ships sailed away"
    named = "Boston lies north of the old harbour and Boston sells fish to all of the towns around"
    items = [(1, long), (2, short), (3, named)]
    texts = [
        (1, f"As we now ask, {long.lower()}."), (2, f"so we ask {long} again"), (3, long.upper()), (4, f"and then {short} from here"), (5, f"{long}."),
        (6, "they say that " + named.replace("Boston", "Dover")), (7, "they say that " + named.replace("Boston", "Dover", 1).replace("Boston", "Salem")),
        (8, "Every farmer near the river sells fresh apples to nobody."), (9, None),
    ]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in texts], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert {r.doc_id for r in corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).collect()} == {8, 9}
