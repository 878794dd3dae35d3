import numpy as np
import pytest
from pyspark.sql import functions as F

from flowrisk.operators import clean, prep
from flowrisk.operators.features import derive_features
from flowrisk.plans.queries_prepare import repeated_names
from flowrisk.schema import BASELINE_LEAK_COLUMNS
from flowrisk.sources.csv_files import csv_headers, csv_paths, read_csv_folder
from flowrisk.sources.records import from_payloads, from_records, rejected_payloads

DEMO = [
    dict(duration=35.2, src_bytes=1820, dst_bytes=1250, packet_rate=14.5, connections_to_same_host=3,
         unique_dst_ports=2, failed_logins=0, dst_port=443, protocol_type="tcp"),
    dict(duration=2.1, src_bytes=68, dst_bytes=20, packet_rate=620, connections_to_same_host=380,
         unique_dst_ports=1, failed_logins=0, dst_port=80, protocol_type="tcp"),
]


def test_features_of_a_benign_flow(spark):
    r = derive_features(from_records(spark, DEMO[0])).first()
    assert r["total_bytes"] == 3070
    assert r["byte_ratio"] == 1821 / 1251
    assert r["byte_asymmetry"] == 570 / 3071
    assert r["bytes_per_sec"] == 3070 / 35.201
    assert (r["port_dispersion_ratio"], r["failed_login_ratio"]) == (0.5, 0.0)


def test_feature_blocks_follow_the_columns(spark):
    only = derive_features(spark.createDataFrame([(5.0, "x")], "duration double, total_bytes string"))
    assert only.columns == ["duration", "total_bytes", "bytes_per_sec"]
    assert only.first()["bytes_per_sec"] is None
    given = derive_features(spark.createDataFrame([(1.0, 10.0)], "duration double, total_bytes double")).first()
    assert given["bytes_per_sec"] == 10 / 1.001
    assert derive_features(from_records(spark, DEMO), enabled=False).columns == from_records(spark, DEMO).columns
    zero = spark.createDataFrame([(1, -1)], "unique_dst_ports int, connections_to_same_host int")
    assert derive_features(zero).first()["port_dispersion_ratio"] is None


def test_records(spark):
    assert from_records(spark, DEMO).count() == 2
    df = from_records(spark, [{"duration": 1}, {"dst_port": 80}])
    assert sorted(map(tuple, df.collect()), key=str) == [(1.0, None), (None, 80)]
    assert from_records(spark, []).count() == 0
    assert from_records(spark, df) is df
    with pytest.raises(TypeError):
        from_records(spark, "flow")
    with pytest.raises(TypeError):
        from_records(spark, [1, 2])


def test_payload_shapes(spark):
    bodies = ['{"flows": [{"dst_port": 1}, {"dst_port": 2}]}', '[{"dst_port": 3}]', ' {"dst_port": 4, "more": 1}',
              '{"flows": []}', "[]", "{cut", "5", '"text"', "", None]
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    got = {(r["id"], r["position"], r["dst_port"]) for r in from_payloads(df, "body").collect()}
    assert got == {(0, 0, 1), (0, 1, 2), (1, 0, 3), (2, 0, 4)}
    assert tuple(rejected_payloads(df, "body").first()) == (10, 5, 4, 0)


def test_no_payload_is_lost_uncounted(spark):
    bodies = ["[1,2]", '{"flows": 5}', '[{"dst_port":1},7]', '{"flows": null}', '{"flows": [null, {"dst_port": 2}, {"dst_port": "x"}]}',
              '[[{"dst_port": 3}]]', '{"dst_port": 4, "flows2": 1}']
    df = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    got = {(r["id"], r["position"], r["dst_port"]) for r in from_payloads(df, "body").collect()}
    assert got == {(2, 0, 1), (4, 1, 2), (4, 2, None), (6, 0, 4)}
    payloads, rejected, elements, bad = rejected_payloads(df, "body").first()
    assert (payloads, rejected) == (7, 2) and elements - bad == len(got)


def test_csv_blank_lines_quotes_and_line_ends(spark, tmp_path):
    (tmp_path / "a.csv").write_text('\n  \nx,y\n"say ""hi"", you",1\n\n"C:\\",2\n')
    (tmp_path / "b.csv").write_bytes(b"\xef\xbb\xbfx,y\r\nplain,3\r\n")
    got = sorted(map(tuple, read_csv_folder(spark, str(tmp_path)).select("x", "y").collect()))
    assert got == [("C:\\", 2), ("plain", 3), ('say "hi", you', 1)]
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "c.csv").write_text('x,y\n"two\nlines",4\n')
    got = read_csv_folder(spark, str(tmp_path / "deep"), multi_line=True).collect()
    assert [tuple(r) for r in got] == [("two\nlines", 4)]
    (tmp_path / "empty.csv").write_text("\n\n")
    with pytest.raises(ValueError):
        read_csv_folder(spark, str(tmp_path))


def test_a_row_like_the_header_is_a_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n\t\nx,y\nx,y\n1,2\n")
    got = sorted(map(tuple, read_csv_folder(spark, str(tmp_path)).collect()))
    assert got == [("1", "2"), ("x", "y")]


def test_white_space_around_names_and_labels(spark):
    df = spark.createDataFrame([("DoS\t", 1.0, 2.0), ("\u00a0DoS\r\n", 1.0, 2.0)], "`label\t` string, `rate ` double, ` rate` double")
    made = clean.clean_flows(df, training=True)
    assert made.columns == ["label", "rate", "rate.1"]
    assert [r["label"] for r in made.collect()] == ["DoS", "DoS"]
    assert clean.distinct_names(["a", "a", "a.1", "a", ""]) == ["a", "a.2", "a.1", "a.3", ""]


def test_headers_come_from_one_job(spark, tmp_path):
    for i in range(30):
        (tmp_path / f"{i}.csv").write_text(f"x,{'y' if i % 2 else 'z'}\n1,2\n")
    tracker, group = spark.sparkContext.statusTracker(), "headers"
    spark.sparkContext.setJobGroup(group, group)
    headers = csv_headers(spark, str(tmp_path)).collect()
    jobs = len(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("", "")
    assert sorted((h["header"], h["n_files"]) for h in headers) == [("x,y", 15), ("x,z", 15)] and jobs <= 4


def test_names_with_dots(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,x,Fwd Header Length,Fwd Header Length,label\n" + "".join(
        f"{i},{i % 3 + 0.5},1,1,{'DoS' if i % 2 else 'Normal'}\n" for i in range(60)))
    raw = read_csv_folder(spark, str(tmp_path))
    assert raw.columns == ["x", "x.1", "Fwd Header Length", "Fwd Header Length.1", "label"]
    made = clean.clean_flows(raw, training=True)
    assert made.columns == ["x", "x.1", "Fwd Header Length", "label"] and made.count() == 60
    assert clean.clean_baseline(raw).columns == ["x", "x.1", "label"]
    stats = prep.fit_stats(made, exclude=["label"])
    assert stats.numeric["x.1"].median == 1.5 and stats.transform(made).count() == 60


def test_one_hot_vectors(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a"), (4, "b")], "id int, service string")
    got = {r["id"]: r["v"].toArray().tolist() for r in prep.one_hot_vectors(df, "service", "v").collect()}
    assert got == {1: [0, 1, 0], 2: [0, 0, 1], 3: [1, 0, 0], 4: [0, 1, 0]}


def test_one_hot_column_names_no_category(spark):
    df = spark.range(30_000).select(F.concat(F.lit("s"), "id").alias("service"))
    made = prep.one_hot_vectors(df, "service", "v")
    assert made.schema["v"].metadata == {"ml_attr": {"num_attrs": 30_000}}
    vector = made.filter("service = 's7'").first()["v"]
    code = sorted(f"s{i}" for i in range(30_000)).index("s7")
    assert (vector.size, vector.indices.tolist(), vector.values.tolist()) == (30_000, [code], [1.0])
    assert prep.one_hot_vectors(df.limit(0), "service", "v").count() == 0


def test_clean_flows(spark):
    rows = [(1.0, " DoS ", "1.1.1.1", 5), (float("inf"), "Normal", "x", 6), (float("nan"), None, "y", 7)]
    df = spark.createDataFrame(rows, "`rate ` double, ` Label` string, ` Src IP` string, id int")
    made = clean.clean_flows(df, training=True)
    assert made.columns == ["rate", "Label"]
    assert [tuple(r) for r in made.collect()] == [(1.0, "DoS"), (None, "Normal")]
    assert clean.clean_flows(df).count() == 3
    assert "id" in clean.clean_flows(df, keep=["id"]).columns
    assert clean.split_target(made) == (["rate"], "Label")
    assert clean.find_target(spark.range(1)) is None


def test_leak_lists(spark):
    df = spark.createDataFrame([(1,) * 6], "src_ip int, `Src IP` int, `Dst Port` int, time int, protocol int, a int")
    assert clean.leak_columns(df, ["src ip", "time"]) == ["Src IP", "time"]
    assert clean.leak_columns(df, ["src ip"], normalize_underscores=True) == ["src_ip", "Src IP"]
    assert clean.leak_columns(df, BASELINE_LEAK_COLUMNS) == ["Src IP", "Dst Port", "protocol"]


def test_clean_baseline(spark):
    rows = [(1.0, 2, 7, "a", "x", " DoS"), (None, 3, 7, "a", "x", "DoS"), (2.0, 4, 7, "a", None, "DoS"),
            (float("inf"), 4, 7, "a", "x", "DoS"), (5.0, 9, 7, "a", "x", "Normal")]
    df = spark.createDataFrame(rows, "a double, b int, c int, protocol string, text string, ` Label` string")
    made = clean.clean_baseline(df)
    assert made.columns == ["a", "b", "Label"]
    assert sorted(map(tuple, made.collect())) == [(1.0, 2, "DoS"), (5.0, 9, "Normal")]
    with pytest.raises(ValueError):
        clean.clean_baseline(spark.range(3))


def test_stats_and_transform(spark):
    rows = [(1.0, 4, "tcp", 5.0), (None, 4, "udp", 5.0), (3.0, 4, None, 5.0), (8.0, 4, "tcp", 5.0), (float("nan"), 4, "tcp", 5.0)]
    df = spark.createDataFrame(rows, "x double, y int, protocol_type string, z double")
    for few in (1, 1000):
        stats = prep.fit_stats(df, few=few)
        assert stats.numeric["x"].median == 3.0
        filled = np.array([1.0, 3.0, 3.0, 8.0, 3.0])
        assert stats.numeric["x"].mean == pytest.approx(filled.mean(), rel=1e-14)
        assert stats.numeric["x"].std == pytest.approx(filled.std(), rel=1e-14)
        assert stats.numeric["y"].std == 0.0
    assert stats.feature_names == ["x", "y", "z", "protocol_type_missing", "protocol_type_tcp", "protocol_type_udp"]
    assert prep.FitStats.from_json(stats.to_json()) == stats
    # Absent numbers become the median, absent or unseen categories all zeros or "missing".
    other = spark.createDataFrame([("n/a", "icmp"), ("8", "udp")], "x string, protocol_type string")
    vectors = [r["features"].toArray().tolist() for r in stats.transform(other).collect()]
    assert vectors[0][1:] == [0, 0, 0, 0, 0]
    assert vectors[0][0] == pytest.approx((3 - 3.6) / filled.std())
    assert vectors[1][3:] == [0, 0, 1]
    nothing = spark.createDataFrame([(4,)], "y int")
    assert stats.transform(nothing).first()["features"].toArray()[3:].tolist() == [1, 0, 0]


def test_no_feature_at_all(spark):
    df = spark.createDataFrame([("a",)], "text string")
    with pytest.raises(ValueError):
        prep.fit_stats(df).transform(df)


def test_column_of_nulls_has_median_zero(spark):
    stats = prep.fit_stats(spark.createDataFrame([(None,), (None,)], "x double"))
    assert stats.numeric["x"] == prep.NumericStats(0.0, 0.0, 0.0)


def test_csv_folder(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    (tmp_path / "a.csv").write_text('dst_port, Label,rate\n80,"DoS, big",1.5\n443,Normal,inf\n')
    (tmp_path / "deep" / "b.csv").write_text(" Label,dst_port\nPortScan,22\nN/A,21\n")
    (tmp_path / "deep" / "er" / "c.csv").write_text("dst_port, Label,rate\n25,DoS,\n")
    (tmp_path / "notes.txt").write_text("dst_port\n1\n")
    assert [p.rsplit("/", 1)[1] for p in csv_paths(spark, str(tmp_path))] == ["a.csv", "b.csv", "c.csv"]
    df = read_csv_folder(spark, str(tmp_path))
    assert dict(df.dtypes) == {"dst_port": "bigint", " Label": "string", "rate": "double"}
    got = sorted(map(tuple, df.select("dst_port", " Label", "rate").collect()))
    assert got == [(21, None, None), (22, "PortScan", None), (25, "DoS", None), (80, "DoS, big", 1.5), (443, "Normal", None)]
    typed = read_csv_folder(spark, str(tmp_path), {"dst_port": "int", "Label": "double"})
    assert typed.filter(F.col(" Label").isNotNull()).count() == 0
    with pytest.raises(FileNotFoundError):
        read_csv_folder(spark, str(tmp_path / "deep" / "none"))


def test_csv_repeated_names(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,x,y\n1,2,3.5\n")
    df = read_csv_folder(spark, str(tmp_path))
    assert df.columns == ["x", "x.1", "y"]
    assert tuple(df.first()) == (1, 2, 3.5)


def test_taxonomy_search_and_filters(spark):
    df = spark.createDataFrame([("Neptune ",), ("nmap",), ("normal",), ("spy",), (None,)], "name string")
    assert [r[1] for r in clean.attack_category(df, "name").collect()] == ["DoS", "PortScan", "Normal", "Other", "Other"]
    flows = spark.createDataFrame([(80, "tcp", None), (443, "udp", "DoS")], "dst_port int, proto string, label string")
    found = clean.search(flows, "do", ["dst_port", "proto", "label"])
    assert [r["dst_port"] for r in found.collect()] == [443]
    assert clean.search(flows, "80", ["dst_port", "label"]).count() == 1
    assert clean.first_rows(flows, ["dst_port"], 0).count() == 2


def test_repeated_names_of_events_in_several_files(spark, tmp_path):
    event = "id event_id, id % 3 user_id, timestamp_ntz'2024-01-01 00:00:00' ts, 'view' event_type, cast(id % 5 as double) value, '{\"k\": 4}' props"
    spark.range(40, numPartitions=3).selectExpr(*event.replace(" user_id", " user_id").split(", ")).write.parquet(str(tmp_path / "events.parquet"))
    made = repeated_names(spark, str(tmp_path))
    assert made.columns == ["x", "x1", "label"]
    assert sorted((r["x"], r["x1"]) for r in made.collect()) == [(float(i), i % 5 * 8.0) for i in range(40)]
