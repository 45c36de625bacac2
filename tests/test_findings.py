"""One small case for each fault the review of the third round found."""

import math
from datetime import date

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from brackish.operators import graph, joins, nearest
from brackish.operators.quantiles import with_quantiles
from brackish.plans import evaluation, registry
from tests.oracle import compare

registry.load_all()


def _estimate_bits(df):
    """Length in bits of the planner's estimate of a table's size."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())).bit_length()


def test_rounds_do_not_square_size_estimates(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    got = graph.components(chain, "a", "b")
    assert _estimate_bits(got) < 500
    assert [tuple(r) for r in got.groupBy("component").count().collect()] == [(0, 301)]
    ring = spark.range(200).select(F.col("id").alias("a"), ((F.col("id") + 1) % 200).alias("b"))
    order = graph.ring_order(ring, "a", "b")
    assert _estimate_bits(order) < 500
    assert [(r.ring, r.node) for r in order.orderBy("position").collect()] == [(0, i) for i in range(200)]
    far = graph.hop_distance(spark.range(31).toDF("n"), chain.where("a < 30"), spark.range(1).toDF("n"), "n", "a", "b")
    assert _estimate_bits(far) < 1000
    assert sorted(tuple(r) for r in far.collect()) == [(i, i) for i in range(31)]


def test_case_inventory_names_the_sources(spark, tmp_path):
    rows = [(1, "en", "web", 5), (2, "en", "book", 7), (3, "en", "web", None), (4, None, None, 2), (5, "de", None, 1), (6, "de", "a", 1)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.lang: (r.bytes, r.records, r.sources) for r in evaluation.case_inventory(spark, str(tmp_path)).collect()}
    assert got == {"en": (12, 3, "book,web"), None: (2, 1, ""), "de": (2, 2, "a")}


def _folder(path, **tables):
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), str(path / f"{name}.parquet"))
    return str(path)


def _sql(folder, text, *tables):
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con.execute(text).to_arrow_table()


@pytest.mark.parametrize("name", ["gages_in_regions", "tin_interpolate", "priority_overlay", "tile_coverage", "point_in_triangle"])
def test_one_place_is_looked_up_once(spark, tmp_path, monkeypatch, name):
    """Order keys repeat their place every 612,000, regions their outline every 5,100."""
    keys = [base + k for base in (0, 612_000, 1_224_000) for k in range(400)]
    parts = [base + k for base in (0, 5_100) for k in range(600)]
    kinds = ["SMALL", "LARGE", "PROMO"]
    folder = _folder(
        tmp_path,
        orders={"o_orderkey": keys, "o_custkey": keys, "o_totalprice": [k % 977 * 310.0 for k in keys], "o_orderdate": [date(2020, 1, 1)] * len(keys), "o_orderpriority": ["1"] * len(keys), "o_orderstatus": ["O"] * len(keys)},
        part={"p_partkey": parts, "p_size": [k % 5_100 % 50 + 1 for k in parts], "p_brand": [f"Brand#{k % 4}" for k in parts], "p_type": [kinds[k % 5_100 % 3] for k in parts], "p_retailprice": [1.0 * k for k in parts]},
    )
    asked, plain = [], joins.points_in_boxes

    def seen(points, boxes, *rest, **how):
        asked.append((points.count(), points.select("_px", "_py").distinct().count() if "_px" in points.columns else points.select("lon", "lat").distinct().count()))
        return plain(points, boxes, *rest, **how)

    monkeypatch.setattr(joins, "points_in_boxes", seen)
    got = registry.QUERIES[name](spark, folder).toArrow()
    assert got.num_rows and compare(got, _sql(folder, registry.ORACLES[name], "orders", "part")) == []
    assert asked and all(rows == places for rows, places in asked)


def test_large_groups_are_not_moved_for_quantiles(spark):
    rows = spark.range(3000).select(F.when(F.col("id") % 10 != 0, "hot").when(F.col("id") % 20 == 0, "cold").alias("k"), (F.col("id") * 7919 % 3001).cast("double").alias("v"))
    want = {r.k: r.q for r in rows.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.05), F.lit(0.5))).alias("q")).collect()}
    found = with_quantiles(rows, ["k"], F.col("v"), [0.05, 0.5], rows_per_task=10, accuracy=1000)
    got = {r.k: r.quantiles for r in found.collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    # Brackets of large groups go to the values, once to be counted and once to be ranked, and once to set these groups aside.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") >= 3


@pytest.mark.parametrize("most", [20_000, 30])
def test_groups_of_points_share_their_search(spark, monkeypatch, most):
    monkeypatch.setattr(nearest, "GROUP_SOURCES", most)
    monkeypatch.setattr(nearest, "CHUNK_POINTS", 7)
    walked, walk = [], nearest._walk
    monkeypatch.setattr(nearest, "_walk", lambda asking, place, who, *rest: walked.append((who, asking.count())) or walk(asking, place, who, *rest))
    rng = np.random.default_rng(5)
    at = lambda n, scale: (rng.integers(0, 40, (n, 2)) * scale).tolist()
    points = [(i, *p) for i, p in enumerate(at(600, 1.0) + [[1e6, -1e6], [500.0, 3.0]])] + [(3, 7.0, 7.0), (None, 1.0, 1.0), (700, None, 2.0)]
    sources = [(i, *p) for i, p in enumerate(at(150, 1.0) + at(100, 0.01))] + [(900, 5.0, None)]
    got = nearest.k_nearest(
        spark.createDataFrame(points, "p long, x double, y double"), spark.createDataFrame(sources, "s long, x double, y double"), "p", "s", k=3, leaf_rows=8, group_points=4
    )
    found = {}
    for r in got.collect():
        found.setdefault(r.p, []).append((r["rank"], r.distance, r.s))
    want = {}
    for p, px, py in points:
        if px is not None:
            want.setdefault(p, []).extend((math.sqrt((sx - px) ** 2 + (sy - py) ** 2), s) for s, sx, sy in sources if sy is not None)
    assert {p: sorted(rows) for p, rows in found.items()} == {p: [(i + 1, d, s) for i, (d, s) in enumerate(sorted(rows)[:3])] for p, rows in want.items()}
    alone = dict(walked)["_pid"]
    assert alone < 20 if most > 30 else alone > 20


def test_simhash_names_near_copies_in_the_pipeline(spark, monkeypatch):
    pytest.importorskip("brackish.llm.shingles")
    import corpus_pipeline
    from brackish.llm import shingles

    monkeypatch.setattr(shingles, "candidates", lambda nodes: nodes.where("false").select(F.col("id").alias("a"), F.col("id").alias("b")))
    words = [f"w{i * 7919 % 100_003}" for i in range(3000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, "more"])), (3, " ".join(words[:1000])), (4, "else"), (5, " ".join(words[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.near_copies(spark, docs, "").collect()) == [1, 3, 4, 5]


def test_long_strip_takes_few_rounds(spark, monkeypatch):
    """rounds do not grow with the squares of a fixed side that lie behind each other in a narrow grid."""
    from brackish.operators import grids

    written = []
    for name in ("cut_lineage", "cut_rounds"):
        plain = getattr(grids, name, None)
        monkeypatch.setattr(grids, name, lambda df, plain=plain: written.append(1) or plain(df), raising=False)
    strip = spark.range(6000).select(F.floor(F.col("id") / 3).alias("j"), (F.col("id") % 3).alias("i"), (F.col("id") % 7 != 3).alias("wet"))
    got = {(r.j, r.i): (r.distance, r.source) for r in grids.wet_distance(strip, F.col("wet"), F.col("j") == 0, 50.0, 40.0, 3).collect()}
    assert len(written) < 8
    cells = {(k // 3, k % 3) for k in range(6000) if k % 7 != 3}
    assert got.keys() == cells
    best = {c: (0.0, c[1]) for c in cells if c[0] == 0}
    for _ in range(3):  # down and up with all ways along a row
        for order in (range(2000), range(1999, -1, -1)):
            for j in order:
                for _ in range(3):
                    for i in range(3):
                        offers = [(best[n][0] + 50.0 * abs(b) if not a else best[n][0] + math.hypot(40.0, 50.0 * b), best[n][1]) for a in (-1, 0, 1) for b in (-1, 0, 1) if (n := (j + a, i + b)) in best and n != (j, i)]
                        if (j, i) in cells and offers and min(offers)[0] < best.get((j, i), (math.inf,))[0] - 1e-9:
                            best[j, i] = min(offers)
    assert all((d is None and c not in best) or abs(d - best[c][0]) < 1e-6 for c, (d, _) in got.items())
    # Cut into blocks of 64 cells, values and labels stay.
    monkeypatch.setattr(grids, "BLOCK_CELLS", 64)
    short = strip.where("j < 100")
    parts = {(r.j, r.i): (r.distance, r.source) for r in grids.wet_distance(short, F.col("wet"), F.col("j") == 0, 50.0, 40.0, 3).collect()}
    assert all(parts[c][1] == got[c][1] and abs(parts[c][0] - got[c][0]) < 1e-6 for c in parts if got[c][0] is not None)


def test_windows_cut_tokens_once(spark):
    """op2_decontam: one hash a token, windows of every length, texts cut into tokens once."""
    from brackish.llm import decontam

    texts = [(1, "say Foo Bar Baz, Qux 3 km \x01 Odd and SoOn, one two three four"), (2, "too short"), (3, None), (4, ""), (5, "one two three four five six seven")]
    rows = spark.createDataFrame(texts, "doc_id long, text string")
    hashes = rows.select("doc_id", decontam._token_hashes(decontam.valued(F.col("text"))).alias("hashes"))
    got = decontam._hashed_windows(hashes, "doc_id", "hashes", [5, 8])
    assert got._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    tokens = {r.doc_id: r.t for r in rows.select("doc_id", decontam._bare(decontam.valued(F.col("text"))).alias("t")).collect()}
    assert tokens[1][:7] == ["say", "\x01", "\x01", "\x01", "\x01", "\x02", "\x03"]
    forms = [(d, " ".join(t[k:k + n])) for d, t in tokens.items() for n in (5, 8) for k in range(len(t) - n + 1)]
    want = spark.createDataFrame(forms, "doc_id long, form string").select("doc_id", F.xxhash64(F.transform(F.split("form", " "), lambda t: F.xxhash64(t))).alias("hash"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 10


def test_covered_lines_are_paired_once(spark, monkeypatch):
    """segments that cover each other on a line along an axis meet the others as one, with the same edges."""
    from brackish.operators import arrangement as A

    counted, plain = [], A.close_pairs
    monkeypatch.setattr(A, "close_pairs", lambda known: counted.append(plain(known).count()) or plain(known))
    lines = [(float(k), 5.0, k + 50.0, 5.0) for k in range(60)] + [(10.5 + k, 0.0, 10.5 + k, 10.0) for k in range(5)] * 2 + [(0.0, 0.0, 10.0, 10.0), (200.0, 5.0, 210.0, 5.0)]
    edges = A.noded(spark.createDataFrame(lines, "x1 double, y1 double, x2 double, y2 double"))
    cuts = sorted({float(k) for k in range(110)} | {10.5 + k for k in range(5)})
    want = {((a, 5.0), (b, 5.0)) for a, b in zip(cuts, cuts[1:], strict=False)} | {((200.0, 5.0), (210.0, 5.0)), ((0.0, 0.0), (5.0, 5.0)), ((5.0, 5.0), (10.0, 10.0))}
    want |= {((10.5 + k, a), (10.5 + k, b)) for k in range(5) for a, b in ((0.0, 5.0), (5.0, 10.0))}
    assert {tuple(tuple(e) for e in r) for r in edges.collect()} == want
    assert counted[0] < 300


def test_long_meshes_stay_off_the_driver(spark, tmp_path):
    """mesh_metrics: what is as long as the mesh, and small only as a packed file, is not sent through the driver."""
    keys = [*range(700)]
    folder = _folder(tmp_path, part={"p_partkey": [*keys, None], "p_retailprice": [1.0 * k for k in keys] + [2.0]})
    got = registry.QUERIES["mesh_metrics"](spark, folder)
    assert "HashedRelationBroadcastMode" not in got._jdf.queryExecution().executedPlan().toString()
    assert compare(got.toArrow(), _sql(folder, registry.ORACLES["mesh_metrics"], "part")) == []
