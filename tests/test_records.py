"""Known answers for selection, preference, conversion, reading and writing."""

import json
import struct

import pytest
from pyspark.sql import functions as F

from brackish.functions import documents as D
from brackish.functions import geo as G
from brackish.functions import hydrology as H
from brackish.functions import names as N
from brackish.functions import timeaxis as T
from brackish.functions import units as U
from brackish.operators import dedupe, metrics, quality, sampling, vertical
from brackish.sinks import writers
from brackish.sources import geometry, tables, text
from brackish.streaming import streams

INDEX = """# Title : profile index
# Date of update : 20250105000000
file,date,latitude,longitude,ocean,profiler_type,institution,date_update,parameters
aoml/5900001/profiles/R5900001_001.nc,20250101000000,10.0,170.0,P,846,AO,20250105000000,PRES DOXY CHLA
aoml/5900001/profiles/D5900001_002.nc,20250102000000,0.0,-179.0,P,846,AO,20250105000000,PRES DOXY
coriolis/5900002/profiles/BR5900002_001.nc,20250103000000,20.0,-160.0,P,846,IF,20250105000000,PRES DOXY
aoml/5900003/profiles/R5900003_001.nc,20250103000000,,,P,846,AO,20250105000000,
aoml/5900003/profiles/X5900003_001.nc,20250103000000,1,1,P,846,AO,20250105000000,
"""


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_profile_selection(spark, tmp_path):
    (tmp_path / "index.txt").write_text(INDEX)
    df = text.profile_index(spark, str(tmp_path / "index.txt"), "bio")
    assert df.count() == 3 and {r.file_mode for r in df.collect()} == {"R", "D"} and {r.dac for r in df.collect()} == {"aoml", "coriolis"}
    lon, lat = F.col("longitude"), F.col("latitude")
    near = df.where(F.col("date_compact").between("20250101000000", "20250102000000") & G.in_bbox(lon, lat, (169, 9, 171, 11)))
    assert [r.file for r in near.collect()] == ["aoml/5900001/profiles/R5900001_001.nc"]
    assert df.where(G.in_bbox(lon, lat, (175, -5, -175, 5))).count() == 1
    assert df.where(G.in_ring(lon, lat, [(170.0, 10.0), (172.0, 10.0), (172.0, 12.0)])).count() == 1  # a corner is inside
    have = D.words(F.col("parameters"))
    assert df.where(D.has_all(have, ["DOXY", "CHLA"])).count() == 1 and df.where(D.has_any(have, ["DOXY", "CHLA"])).count() == 3


def test_preference_and_conflict(spark):
    def judge(rows):
        df = spark.createDataFrame(rows, "t string, key string, naming string, size long, etag string")
        rank = F.when(F.col("naming") == "current", 1).otherwise(0)
        return df, rank, dedupe.rank_conflicts(df, ["t"], rank, [F.col("size"), F.col("etag")], "key")

    for rows in ([("t", "b", "legacy", 1, "x"), ("t", "a", "current", 2, "y")],) * 2:
        r = judge(rows)[2].first()
        assert (r.preferred, r.verdict, r.candidates) == ("a", "single", 2)
    df, rank, v = judge([("t", "b", "legacy", 1, "x"), ("t", "a", "legacy", 1, "x")])
    assert (v.first().preferred, v.first().verdict) == ("a", "identical")
    lost = dedupe.rejected_candidates(df, v, ["t"], rank, "key").first()
    assert (lost.key, lost.reason) == ("b", "same_rank_identical_remote_metadata")
    for etag in ("z", None):
        v = judge([("t", "b", "legacy", 1, "x"), ("t", "a", "legacy", 1, etag)])[2]
        assert v.first().verdict == "conflict"
        with pytest.raises(Exception, match="conflict"):
            dedupe.refuse_conflicts(v).collect()


def test_boundary_time_belongs_to_the_earlier_run(spark):
    df = spark.createDataFrame([("s", 6, "06"), ("s", 6, "00"), ("s", 7, "06")], "k string, t long, run string")
    assert {r.t: r.run for r in dedupe.earliest_source(df, ["k"], "t", [F.col("run")]).collect()} == {6: "00", 7: "06"}


def test_sample_ignores_order(spark):
    rows = [(f"f{i}", "ab"[i % 2] if i < 150 else "c") for i in range(200)]
    pick = lambda r: {x.f for x in sampling.stratified_sample(spark.createDataFrame(r, "f string, s string"), ["s"], "f", 64).collect()}
    assert pick(rows) == pick(rows[::-1]) and len(pick(rows)) == 64


def test_greedy_cover_matches_a_walk(spark):
    rows = [(i, s, s + n) for i, (s, n) in enumerate([(0, 5), (0, 3), (2, 3), (4, 6), (20, 1), (5, 4), (9, 2)])]
    got = {r.id: r.adds for r in dedupe.covering_intervals(spark.createDataFrame(rows, "id long, s long, e long"), [], "s", "e", ["id"]).collect()}
    covered = set()
    for i, s, e in sorted(rows, key=lambda r: (r[1], r[0])):
        assert got[i] == bool(set(range(s, e)) - covered)
        covered |= set(range(s, e))


def test_scores_that_are_undefined(spark):
    rows = [("flat", 1.0, 2.0), ("flat", 3.0, 2.0), ("one", 1.0, 1.0), ("none", None, 1.0), ("zero", 1.0, 1.0), ("zero", 2.0, -1.0)]
    got = {r.k: r for r in metrics.skill_scores(spark.createDataFrame(rows, "k string, s double, o double"), ["k"], "s", "o").collect()}
    assert got["flat"].r is None and got["flat"].nse is None and got["flat"].kge is None and got["flat"].rmse == 1.0
    assert got["one"].r is None and got["one"].n_pairs == 1 and got["none"].n_pairs == 0 and got["none"].bias is None
    assert got["zero"].pbias is None and got["zero"].beta is None


def test_layer_weights_of_a_column(spark):
    df = spark.createDataFrame([(1, k, s) for k, s in enumerate([0.5, 0.0, 0.25])], "c long, layer long, sigma double")
    top = {r.sigma: r.weight for r in vertical.layer_top_weights(df, ["c"], "sigma").collect()}
    assert top == {0.0: 0.25, 0.25: 0.25, 0.5: 0.5}
    trap = {r.sigma: r.weight for r in vertical.trapezoid_weights(df, ["c"], "sigma").collect()}
    assert trap == {0.0: 0.25, 0.25: 0.5, 0.5: 0.25}
    for view, layer in (("surface", 1), ("near_surface", 2), ("bottom", 0), ("index:1", 1)):
        assert vertical.pick_layer(df, ["c"], "sigma", view).first().layer == layer
    v = vertical.layer_views(df, ["c"], "sigma", "layer").first()
    assert (v.surface, v.near_surface, v.bottom) == (1, 2, 0)


def test_units_and_gates(spark):
    assert one(spark, U.convert("water_level", F.lit(5.0), F.lit(" CM "))) == 0.05
    assert one(spark, U.convert("precipitation", F.lit(3600.0), F.lit("mm / hr"))) == pytest.approx(0.001)
    assert one(spark, U.convert("air_temperature", F.lit(1.0), F.lit("furlong"))) is None
    with pytest.raises(Exception, match="out_of_range"):
        one(spark, U.require_converted("relative_humidity", F.lit(2.0), F.lit("fraction")))
    assert one(spark, U.departure_to_pascal(F.lit(13.25))) == 101325.0
    assert U.required_roles({"wind", "pressure"}) == ["eastward_wind", "northward_wind", "absolute_air_pressure"]


def test_small_facts(spark):
    assert one(spark, G.utm_epsg(F.lit(-122.4), F.lit(37.8))) == 32610 and one(spark, G.utm_epsg(F.lit(151.2), F.lit(-33.9))) == 32756
    assert one(spark, H.area_to_cells(F.lit(0.001), F.lit(202.0))) == 5 and one(spark, H.area_to_cells(F.lit(1.0), F.lit(100.0))) == 10000
    assert G.unwrap_interval(170, -170) == (170.0, 190.0) and G.unwrap_interval(-180, 180) == (0.0, 360.0)
    assert one(spark, N.public_message(F.lit("see https://h/x?token=1 in /home/me/a, C:\\d\\e"))) == "see https://h/x in [local-path], [local-path]"
    assert one(spark, N.actual_range(F.lit("lat: a\n actual_range: -10.5, 20"), "lat")).asDict() == {"low": -10.5, "high": 20.0}
    assert one(spark, N.covered_years(F.lit("x_1979_1981_v4.zip"), r"x_(\d{4})(?:_(\d{4}))?_v4")) == [1979, 1980, 1981]
    assert one(spark, T.parse_utc(F.lit("2025-01-01T00:00:00"))) is None and one(spark, T.parse_utc(F.lit("2025-01-01T00:00:00Z"))).year == 2025
    assert one(spark, D.stated_bytes(F.lit('{"a": 1, "b": 2}'), {"bytes": ["$.a"], "mb": ["$.b"]})) == 1 + 2 * 1024**2
    assert one(spark, N.cache_path(F.lit("s"), F.lit("p/q.20240102.nc"))).startswith("s/2024/01/")
    crossing = [(F.lit(float(a)), F.lit(float(b))) for a, b in ((0, 0), (2, 2), (0, 2), (2, 0))]
    assert one(spark, G.segments_cross(*crossing)) is True
    apart = [(F.lit(float(a)), F.lit(float(b))) for a, b in ((0, 0), (1, 1), (2, 0), (3, 0))]
    assert one(spark, G.segments_cross(*apart)) is False


def test_station_keys(spark):
    keys = ["d/bay.t06z.20240102.stations.nowcast.nc", "d/bay.t05z.20240102.fields.n001.nc", "d/bay.t06z.20240102.fields.n000.nc", "x/access/bay.t06z.20240102.fields.n000.nc", "d/other.nc", "d/bay.t06z.20249902.fields.f001.nc"]
    rows = N.forecast_keys(spark.createDataFrame([(k,) for k in keys], "key string"), "key", "bay").collect()
    got = {r.key: r for r in rows}
    assert set(got) == {keys[0], keys[3]}
    span = got[keys[0]].expected_end - got[keys[0]].expected_start
    assert got[keys[0]].aggregate and span.total_seconds() == 6 * 3600 + 360 and got[keys[3]].valid_time.hour == 0


def test_sigma_report(spark):
    lev = [(n, k + 1, v) for n, vs in {1: [0.0, -0.5, -1.0], 2: [0.0, -0.6, -0.5], 3: [0.0, -0.4, -0.9]}.items() for k, v in enumerate(vs)]
    lay = [(n, k + 1, v) for n, vs in {1: [-0.2, -0.7], 2: [-0.2, -0.7], 3: [-0.2, -0.7]}.items() for k, v in enumerate(vs)]
    got = {r.n: r.problem for r in vertical.sigma_report(spark.createDataFrame(lay, "n long, layer long, siglay double"), spark.createDataFrame(lev, "n long, level long, siglev double"), ["n"]).collect()}
    assert got == {1: None, 2: "monotonic", 3: "endpoints"}


def test_text_readers(spark, tmp_path):
    (tmp_path / "g.rdb").write_text("# note\nagency_cd\tsite_no\tdatetime\t1_00060_00003\n5s\t15s\t20d\t14n\nAG\t01\t2020-01-01\t100\nAG\t01\t2020-01-02\tIce\n")
    q = text.observed_discharge(spark, str(tmp_path / "g.rdb")).orderBy("date").collect()
    assert [round(r.obs_q_m3s, 6) if r.obs_q_m3s else None for r in q] == [2.831685, None]
    (tmp_path / "m.2dm").write_text("MESH2D\nE3T 1 1 2 3 1\nE4Q 2 1 2 3 4 1\nND 1 0 0 5\nND 2 1 0 5\nND 3 1 1 5\nND 4 0 1 6\nNS 1 2\nNS -3 7\nNS 4 -1\n")
    nodes, tris, strings = text.mesh_2dm(spark, str(tmp_path / "m.2dm"))
    assert nodes.count() == 4 and {r.tri: r.n4 for r in tris.collect()} == {1: None, 2: 4}
    assert sorted((r.chain, r.pos, r.node) for r in strings.collect()) == [(2, 0, 4), (2, 1, 1), (7, 0, 1), (7, 1, 2), (7, 2, 3)]
    (tmp_path / "g.dat").write_text("Node Number = 3\nCell Number = 1\n1 1 2 3 1\n1 0.0 0.0\n2 1.0 0.0 0\n3 1.0 1.0 0 0\n")
    n2, t2 = text.grid_dat(spark, str(tmp_path / "g.dat"))
    assert n2.count() == 3 and t2.first().n3 == 3
    (tmp_path / "run.nml").write_text("&CASE\n START = '2020-01-01', ! from here\n N=4\n/\n")
    assert {r.key: r.value for r in text.namelist(spark, str(tmp_path / "run.nml")).collect()} == {"START": "2020-01-01", "N": "4"}
    (tmp_path / "s.csv").write_text("Datetime,WL,node\n2020-01-01T00:00:00Z,1.5,3\nbad,,4\n")
    s = text.series_csv(spark, str(tmp_path / "s.csv"), {"time": ["time", "datetime"], "value": ["wl"]}).orderBy("node").collect()
    assert s[0].value == 1.5 and s[0].time.year == 2020 and s[1].time is None
    (tmp_path / "l.xml").write_text("<ListBucketResult><Contents><Key>a.nc</Key><Size>5</Size><ETag>\"e\"</ETag></Contents><Contents><Key>b</Key><Size>0</Size></Contents></ListBucketResult>")
    assert [(r.key, r.size, r.etag) for r in text.listing_xml(spark, str(tmp_path / "l.xml")).collect()] == [("a.nc", 5, "e")]


def test_geometry_readers(spark, tmp_path):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"n": "a"}, "geometry": {"type": "Polygon", "coordinates": [ring]}}, {"type": "Feature", "properties": {}, "geometry": {"type": "MultiPolygon", "coordinates": [[ring], [ring]]}}]}
    (tmp_path / "g.json").write_text(json.dumps(doc))
    rings = geometry.geojson_rings(spark, str(tmp_path / "g.json"))
    assert rings.count() == 3 and len(rings.first().points) == 4
    ways = {"elements": [{"type": "way", "id": 1, "geometry": [{"lon": 0, "lat": 0}, {"lon": 4, "lat": 0}]}, {"type": "node", "id": 2}, {"type": "way", "id": 3, "geometry": [{"lon": 0, "lat": 0}]}]}
    (tmp_path / "w.json").write_text(json.dumps(ways))
    lines = geometry.way_lines(spark, str(tmp_path / "w.json"))
    assert [r.way for r in lines.collect()] == [1]
    seg = geometry.clip_segments(geometry.segments(lines, ["way"], "points"), (1, -1, 3, 1)).first()
    assert (seg.x1, seg.x2) == (1.0, 3.0)
    flat = struct.pack("<BI", 1, 2) + struct.pack("<I4d", 2, 0, 0, 3, 4)
    high = struct.pack(">BI", 0, 1002) + struct.pack(">I6d", 2, 0, 0, 9, 3, 4, 9)
    multi = struct.pack("<BII", 1, 5, 2) + flat + high
    df = spark.createDataFrame([(1, bytearray(flat)), (2, bytearray(high)), (3, bytearray(multi)), (4, bytearray(b"\x01\x01")), (5, None)], "id long, wkb binary")
    good, bad = geometry.raw_lines(df, "wkb")
    assert sorted((r.id, r.part) for r in good.collect()) == [(1, 0), (2, 0), (3, 0), (3, 1)]
    assert {r.points[1].y for r in good.collect()} == {4.0} and {r.reason: r["count"] for r in bad.collect()} == {"unreadable": 1, "missing": 1}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("2024-01-01 06:00:00", 1, 0.5)], "t string, node long, z double").withColumn("t", F.col("t").cast("timestamp_ntz"))
    writers.write_forcing(df, str(tmp_path / "f"), "t")
    back = spark.read.parquet(str(tmp_path / "f")).first()
    assert (back.Itime, back.Itime2, back.time_mjd) == (60310, 21600000, 60310.25)
    assert len(writers.write_many(df, str(tmp_path / "m"), ["csv", "json", "parquet", "orc"])) == 4
    nodes = spark.createDataFrame([(k, float(k), 0.0, 2.0) for k in range(1, 4)], "node long, x double, y double, depth double")
    tris = spark.createDataFrame([(1, 1, 2, 3)], "tri long, n1 long, n2 long, n3 long")
    chain = spark.createDataFrame([(9, 0, 1), (9, 1, 2)], "chain long, pos long, node long")
    writers.write_lines(writers.mesh_2dm_lines(nodes, tris, chain, "m"), str(tmp_path / "mesh"), ["section", "at"], "line")
    n, t, s = text.mesh_2dm(spark, str(tmp_path / "mesh"))
    assert n.count() == 3 and t.count() == 1 and [(r.chain, r.pos, r.node) for r in s.orderBy("pos").collect()] == [(9, 0, 1), (9, 1, 2)]
    r = writers.river_namelist(spark.createDataFrame([("a", 5)], "river string, node long"), "riv.nc").first()
    assert "RIVER_GRID_LOCATION = 5," in r.line and "20*0.05000000000" in r.line
    with pytest.raises(ValueError):
        writers.spread_over_nodes(df, F.col("z"), [0.5, 0.4])


def test_tables(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, float("inf"))], "a double, b double")
    assert [tuple(r) for r in tables.nan_to_null(df).collect()] == [(None, 1.0), (2.0, None)]
    assert tables.with_aliases(df, {"value": ["zz", "A"]}).columns == ["value", "b"]
    with pytest.raises(ValueError):
        tables.with_aliases(df, {"time": ["t"]}, required=["time"])
    with pytest.raises(ValueError):
        quality.require_empty(df, "not empty")
    assert tables.coordinate_roles(df, {"longitude": ["lon", "B"]}) == {"longitude": "b"}
    assert [r.name for r in tables.inventory(df).orderBy("position").collect()] == ["a", "b"]


def test_command_queue_runs_each_file_once(spark, tmp_path):
    inbox, done = tmp_path / "in", tmp_path / "done"
    inbox.mkdir()
    run = lambda: streams.command_queue(
        spark, str(inbox), str(done), str(tmp_path / "out"), str(tmp_path / "progress"), "id string, action string",
        lambda b: b.withColumn("status", F.when(F.col("action") == "stop", "stopped").otherwise("ok")),
    ).awaitTermination()
    (inbox / "1.json").write_text('{"id": "1", "action": "go"}')
    run()
    (inbox / "2.json").write_text('{"id": "2", "action": "stop"}')
    run()
    run()
    got = sorted((r.id, r.status) for r in spark.read.schema("id string, status string").json(str(tmp_path / "out/*")).collect())
    assert got == [("1", "ok"), ("2", "stopped")]


def test_stream_resumes_and_drops_late_rows(spark, tmp_path):
    folder = tmp_path / "in"
    def put(name, rows):
        df = spark.createDataFrame(rows, "k string, t string, v double").withColumn("t", F.col("t").cast("timestamp"))
        df.coalesce(1).write.mode("append").parquet(str(folder))
    schema = "k string, t timestamp, v double"
    go = lambda: streams.drain(streams.tumbling(spark.readStream.schema(schema).parquet(str(folder)), ["k"], "t", "v", "1 hour", "10 minutes"), str(tmp_path / "out"))
    put("a", [("x", "2024-01-01 00:10:00", 1.0), ("x", "2024-01-01 00:50:00", 2.0), ("x", "2024-01-01 02:00:00", 4.0)])
    assert [(r.n, r.total) for r in go().collect()] == [(2, 3.0)]
    put("b", [("x", "2024-01-01 00:20:00", 100.0), ("x", "2024-01-01 04:00:00", 8.0)])  # the first is too late
    assert sorted((r.n, r.total) for r in go().collect()) == [(1, 4.0), (2, 3.0)]


def test_long_node_string_is_read_whole(spark, tmp_path):
    n = 100_050
    (tmp_path / "m.2dm").write_text("MESH2D\nNS " + " ".join(map(str, range(1, n))) + f" -{n}\nNS 1 2 -3\n")
    _, _, strings = text.mesh_2dm(spark, str(tmp_path / "m.2dm"))
    assert {r.chain: r["count"] for r in strings.groupBy("chain").count().collect()} == {1: n, 2: 3}


def test_stream_over_a_folder_of_parts(spark, tmp_path):
    from brackish.streaming import streams

    spark.range(10).repartition(2).write.parquet(str(tmp_path / "things.parquet"))
    assert streams.drain(streams.table_stream(spark, str(tmp_path), "things"), str(tmp_path / "out")).count() == 10
