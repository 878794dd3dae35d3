"""Queries on intake, cleaning, features, preprocessing and splits."""

from pyspark.sql import Window, functions as F

from flowrisk.functions.numeric import half_up
from flowrisk.operators import clean, explore, prep, splits
from flowrisk.operators.features import derive_features
from flowrisk.plans.registry import dirty_flows, flows, query, r6, sql6
from flowrisk.schema import ATTACK_CATEGORIES
from flowrisk.session import shared_path
from flowrisk.sources.csv_files import csv_paths, read_csv_folder
from flowrisk.sources.records import from_payloads, rejected_payloads

KEYS = ["host_id", "ts", "flow_id"]
NUMBERS = ["duration", "src_bytes", "dst_bytes", "packet_rate", "connections_to_same_host",
           "unique_dst_ports", "failed_logins", "dst_port"]
DERIVED = ["total_bytes", "byte_ratio", "byte_asymmetry", "bytes_per_sec",
           "port_dispersion_ratio", "failed_login_ratio"]


def _cleaned(spark, folder):
    rows = clean.clean_flows(dirty_flows(spark, folder), training=True, keep=KEYS)
    return clean.to_numbers(rows, ["src_bytes", "duration"])


@query("""SELECT flow_id, src_bytes, duration, protocol_type, label FROM cleaned""", "cleaned")
def clean_flows(spark, folder):
    return _cleaned(spark, folder).select("flow_id", "src_bytes", "duration", "protocol_type", "label")


@query("""SELECT flow_id, coalesce(src_bytes, 0e0) AS src_bytes, coalesce(duration, 0e0) AS duration
          FROM cleaned""", "cleaned")
def coerce_fill(spark, folder):
    rows = clean.fill(_cleaned(spark, folder), {"src_bytes": 0.0, "duration": 0.0})
    return rows.select("flow_id", "src_bytes", "duration")


_FEATURES_SQL = """
  SELECT flow_id, s + d AS total_bytes, (s + 1e0) / (d + 1e0) AS byte_ratio,
    (s - d) / (s + d + 1e0) AS byte_asymmetry, (s + d) / (t + 0.001e0) AS bytes_per_sec,
    unique_dst_ports / (connections_to_same_host + 1e0) AS port_dispersion_ratio,
    failed_logins / (connections_to_same_host + 1e0) AS failed_login_ratio
  FROM (SELECT *, coalesce(src_bytes, 0e0) AS s, dst_bytes AS d, coalesce(duration, 0e0) AS t FROM {})"""


@query(_FEATURES_SQL.format("flows"))
def flow_features(spark, folder):
    return derive_features(flows(spark, folder)).select("flow_id", *DERIVED)


@query(_FEATURES_SQL.format("cleaned"), "cleaned")
def flow_features_dirty(spark, folder):
    rows = clean.clean_flows(dirty_flows(spark, folder), training=True, keep=KEYS)
    return derive_features(rows).select("flow_id", *DERIVED)


def _stats(spark, folder, only=None):
    rows = _cleaned(spark, folder)
    return rows, prep.fit_stats(rows, exclude=["flow_id", "host_id", "k", "label"], only=only)


@query("""SELECT flow_id, coalesce(src_bytes, (SELECT median(src_bytes) FROM cleaned)) AS src_bytes,
            coalesce(duration, (SELECT median(duration) FROM cleaned)) AS duration FROM cleaned""", "cleaned")
def median_impute(spark, folder):
    rows, stats = _stats(spark, folder, ["src_bytes", "duration"])
    return rows.select("flow_id", *[stats.imputed(rows, c).alias(c) for c in ("src_bytes", "duration")])


def _scaled_sql():
    filled = ", ".join(f"coalesce({c}, (SELECT median({c}) FROM cleaned)) AS {c}" for c in NUMBERS)
    scaled = ", ".join(
        sql6(f"({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled)") + f" AS {c}"
        for c in NUMBERS)
    return f"WITH filled AS (SELECT flow_id, {filled} FROM cleaned) SELECT flow_id, {scaled} FROM filled"


@query(_scaled_sql(), "cleaned")
def standard_scale(spark, folder):
    rows, stats = _stats(spark, folder, NUMBERS)
    scaled = rows.select("flow_id", *[c for c, name in zip(stats.columns(rows), stats.feature_names)
                                      if name in NUMBERS])
    return scaled.select("flow_id", *[r6(c) for c in NUMBERS])


@query("""SELECT flow_id, CAST(protocol_type IS NULL AS INTEGER) * 1e0 AS protocol_type_missing,
            CASE protocol_type WHEN 'tcp' THEN 1e0 ELSE 0e0 END AS protocol_type_tcp,
            CASE protocol_type WHEN 'udp' THEN 1e0 ELSE 0e0 END AS protocol_type_udp FROM cleaned""", "cleaned")
def one_hot(spark, folder):
    rows, stats = _stats(spark, folder, ["protocol_type"])
    return rows.select("flow_id", *stats.columns(rows))


@query("""SELECT flow_id, label, dense_rank() OVER (ORDER BY label) - 1 AS label_code FROM cleaned""", "cleaned")
def label_encode(spark, folder):
    return explore.label_encode(_cleaned(spark, folder), "label", "label_code").select(
        "flow_id", "label", "label_code")


@query("""SELECT flow_id, host, dense_rank() OVER (ORDER BY host) - 1 AS host_code
          FROM (SELECT flow_id, 'h' || CAST(host_id AS VARCHAR) AS host FROM flows)""")
def host_encode(spark, folder):
    rows = flows(spark, folder).select("flow_id", F.concat(F.lit("h"), F.col("host_id").cast("string")).alias("host"))
    return explore.label_encode(rows, "host", "host_code").select("flow_id", "host", "host_code")


@query("""SELECT flow_id, duration, src_bytes, dst_bytes, packet_rate, connections_to_same_host,
            unique_dst_ports, failed_logins, dst_port, label
          FROM cleaned WHERE src_bytes IS NOT NULL AND duration IS NOT NULL AND protocol_type IS NOT NULL""",
       "cleaned")
def baseline_clean(spark, folder):
    rows = clean.to_numbers(dirty_flows(spark, folder), ["src_bytes", "duration"]).drop("k", "host_id", "ts")
    # A constant number and a text go; the dirty columns decide which rows stay.
    rows = rows.withColumns({"sensor": F.lit(7), "Src IP": F.lit("10.0.0.1")})
    return clean.clean_baseline(rows, keep=["flow_id"]).select("flow_id", *NUMBERS, "label")


@query("""SELECT count(*) AS rows_before,
            count(*) FILTER (src_bytes IS NOT NULL AND duration IS NOT NULL AND protocol_type IS NOT NULL) AS rows_after,
            count(*) FILTER (src_bytes IS NULL OR duration IS NULL OR protocol_type IS NULL) AS rows_dropped
          FROM cleaned""", "cleaned")
def missing_rows(spark, folder):
    rows = _cleaned(spark, folder)
    return clean.dropped_rows(rows, rows.na.drop())


def _profile_sql():
    lines = []
    for c in [*NUMBERS, "protocol_type", "label"]:
        kind = "categorical" if c in ("protocol_type", "label") else "numeric"
        text = c if kind == "categorical" else "CAST(NULL AS VARCHAR)"
        value = "CAST(NULL AS DOUBLE)" if kind == "categorical" else f"CAST({c} AS DOUBLE)"
        lines.append(f"""SELECT '{c}' AS "column", '{kind}' AS kind, count(*) FILTER ({c} IS NULL) AS nulls,
            min({value}) AS least, max({value}) AS greatest, min({text}) AS first_text, max({text}) AS last_text
            FROM cleaned""")
    return " UNION ALL ".join(lines)


@query(_profile_sql(), "cleaned")
def column_profile(spark, folder):
    rows = _cleaned(spark, folder).select(*NUMBERS, "protocol_type", "label")
    numeric = F.col("kind") == "numeric"
    return explore.column_profile(rows).select(
        "column", "kind", "nulls",
        F.when(numeric, F.col("least").try_cast("double")).alias("least"),
        F.when(numeric, F.col("greatest").try_cast("double")).alias("greatest"),
        F.when(~numeric, F.col("least")).alias("first_text"),
        F.when(~numeric, F.col("greatest")).alias("last_text"),
    )


_NAMES = ["normal", "neptune", "smurf", "teardrop", "nmap", "ipsweep", "portsweep",
          "guess_passwd", "ftp_write", "rootkit", "buffer_overflow", "spy"]


def _taxonomy_sql():
    names = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(_NAMES))
    groups = " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in ATTACK_CATEGORIES.items())
    return f"""SELECT attack_category, count(*) AS n FROM (
        SELECT CASE name {groups} ELSE 'Other' END AS attack_category
        FROM (SELECT CASE k % 12 {names} END AS name FROM flows)) GROUP BY 1"""


@query(_taxonomy_sql())
def label_taxonomy(spark, folder):
    name = F.element_at(F.array(*map(F.lit, _NAMES)), (F.col("k") % 12 + 1).cast("int"))
    rows = clean.attack_category(flows(spark, folder).select(name.alias("name")), "name")
    return explore.distribution(rows, "attack_category").select("attack_category", "n")


def _payloads(spark, folder):
    """JSON payloads of every shape, one per flow: each 13th is cut short, each 17th has no list
    of flows, and each 19th of the others is a list that begins with a number."""
    one = F.struct("flow_id", "duration", "src_bytes", "dst_port", "protocol_type")
    two = F.array(one, one.withField("protocol_type", F.lit("icmp")))
    i = F.col("flow_id")
    text = (
        F.when(i % 13 == 0, F.substring(F.to_json(two), 1, 20)).when(i % 17 == 0, F.lit('{"flows": null}'))
        .when(i % 19 == 0, F.concat(F.lit("[7, "), F.to_json(one), F.lit("]")))
        .when(i % 3 == 0, F.to_json(one)).when(i % 3 == 1, F.to_json(two))
        .otherwise(F.to_json(F.struct(two.alias("flows"))))
    )
    return flows(spark, folder).select(i.alias("payload_id"), text.alias("body"))


@query("""SELECT flow_id AS payload_id, CAST(position AS INTEGER) AS position, flow_id, duration, src_bytes, dst_port,
            CASE WHEN position = 0 OR flow_id % 19 = 0 THEN protocol_type ELSE 'icmp' END AS protocol_type
          FROM flows, (VALUES (0), (1)) AS p(position)
          WHERE flow_id % 13 <> 0 AND flow_id % 17 <> 0
            AND CASE WHEN flow_id % 19 = 0 THEN position = 1 ELSE position = 0 OR flow_id % 3 <> 0 END""")
def json_envelope(spark, folder):
    return from_payloads(_payloads(spark, folder), "body").select(
        "payload_id", "position", "flow_id", "duration", "src_bytes", "dst_port", "protocol_type")


@query("""SELECT count(*) AS payloads, count(*) FILTER (bad) AS rejected,
            CAST(sum(CASE WHEN bad THEN 0 WHEN flow_id % 19 = 0 OR flow_id % 3 <> 0 THEN 2 ELSE 1 END) AS BIGINT) AS elements,
            count(*) FILTER (NOT bad AND flow_id % 19 = 0) AS rejected_elements
          FROM (SELECT flow_id, flow_id % 13 = 0 OR flow_id % 17 = 0 AS bad FROM flows)""")
def json_rejected(spark, folder):
    return rejected_payloads(_payloads(spark, folder), "body")


@query("""SELECT flow_id, duration, src_bytes, CASE WHEN flow_id % 2 = 0 AND flow_id % 50 <> 7 THEN protocol_type END AS protocol_type,
            label, CASE WHEN flow_id % 50 = 7 THEN 'say "' || CAST(flow_id AS VARCHAR) || '", ok' END AS note FROM flows""")
def csv_union(spark, folder):
    """Files with three headers at two depths, some with blank lines before the header and quotes in quotes."""
    target = shared_path(spark, "csv")
    rows, i = flows(spark, folder), F.col("flow_id")
    even = rows.filter((i % 2 == 0) & (i % 50 != 7)).select("flow_id", "duration", "src_bytes", "protocol_type", "label")
    odd = rows.filter((i % 2 == 1) & (i % 50 != 7)).select("label", "src_bytes", "flow_id", "duration")
    even.write.option("header", "true").csv(f"{target}/even")
    odd.write.option("header", "true").csv(f"{target}/deep/odd")
    line = F.concat_ws(",", i, F.concat(F.lit('"say ""'), i, F.lit('"", ok"')), "label", "duration", "src_bytes")
    # Eight files, each a blank line, the header and its rows.
    share = F.pmod(F.xxhash64(i), F.lit(8))
    first = F.row_number().over(Window.partitionBy("share").orderBy("flow_id")) == 1
    head = F.when(first, F.array(F.lit(" "), F.lit("flow_id,note,label,duration,src_bytes"))).otherwise(F.array().cast("array<string>"))
    noted = rows.filter(i % 50 == 7).withColumn("share", share).select("share", "flow_id", F.concat(head, F.array(line)).alias("lines"))
    noted = noted.repartition("share").sortWithinPartitions("share", "flow_id").select("share", F.explode("lines").alias("value"))
    noted.write.partitionBy("share").text(f"{target}/deep/noted")
    return read_csv_folder(spark, target, pattern="part-*")


@query("SELECT CASE WHEN flow_id % 2 = 0 THEN 'even' ELSE 'odd' END AS part, count(*) AS n FROM flows GROUP BY 1")
def csv_discovery(spark, folder):
    target = shared_path(spark, "csv")
    part = F.when(F.col("flow_id") % 2 == 0, "even").otherwise("odd")
    rows = flows(spark, folder).select("flow_id", part.alias("part"))
    rows.write.partitionBy("part").option("header", "true").csv(target)
    rows.write.json(f"{target}/other")  # not to be found
    found = spark.read.option("header", "true").csv(csv_paths(spark, target))
    path = F.col("_metadata.file_path")
    return found.select(F.regexp_extract(path, "part=(\\w+)/", 1).alias("part")).groupBy("part").agg(
        F.count(F.lit(1)).alias("n"))


_KEYED = """SELECT flow_id, label, CAST('0x' || substr(md5('42:' || CAST(flow_id AS VARCHAR)), 1, 15) AS BIGINT) AS key
            FROM flows"""


SPLIT_SQL = f"""SELECT flow_id, CASE WHEN rn <= (SELECT round_even(0.8e0 * count(*), 0) FROM flows) THEN 'train'
             ELSE 'test' END AS split
           FROM (SELECT flow_id, row_number() OVER (ORDER BY key) AS rn FROM ({_KEYED}))"""


@query(SPLIT_SQL)
def split_80_20(spark, folder):
    return splits.random_split(flows(spark, folder), "flow_id", method="md5").select("flow_id", "split")


@query(f"""SELECT flow_id, CASE WHEN rn <= ceil(0.75e0 * n) THEN 'train' ELSE 'test' END AS split
           FROM (SELECT flow_id, row_number() OVER (PARTITION BY label ORDER BY key) AS rn,
                   count(*) OVER (PARTITION BY label) AS n FROM ({_KEYED}))""")
def split_stratified(spark, folder):
    return splits.stratified_split(flows(spark, folder), "label", "flow_id", method="md5").select("flow_id", "split")


FOLDS_SQL = f"""SELECT flow_id, CAST((rn - 1) * 5 // n AS INTEGER) AS fold
           FROM (SELECT flow_id, row_number() OVER (PARTITION BY label ORDER BY key) AS rn,
                   count(*) OVER (PARTITION BY label) AS n FROM ({_KEYED}))"""


@query(FOLDS_SQL)
def kfold_assign(spark, folder):
    return splits.stratified_folds(flows(spark, folder), "label", "flow_id", method="md5").select("flow_id", "fold")


@query("""SELECT x, x1, label FROM (SELECT flow_id * 1e0 AS x, packet_rate AS x1, label FROM flows)""")
def repeated_names(spark, folder):
    """A file with a repeated header: names with dots through cleaning and fitted statistics."""
    target = shared_path(spark, "csv")
    rows = flows(spark, folder).select(F.col("flow_id").cast("double").alias("x"), F.col("packet_rate").alias("x1"), "label")
    # Each task writes a file and puts the header before its first row.
    first = F.monotonically_increasing_id() == F.shiftleft(F.spark_partition_id().cast("long"), 33)
    rows = rows.withColumn("first", first)
    head = F.when(F.col("first"), F.array(F.lit("x,x,label"))).otherwise(F.array().cast("array<string>"))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("x", "x1", "label")]
    rows.select(F.explode(F.concat(head, F.array(F.concat_ws(",", *cells))))).write.text(target)
    made = clean.clean_baseline(read_csv_folder(spark, target, pattern="part-*"))
    stats = prep.fit_stats(made, exclude=["label"])
    back = [(c * stats.numeric[n].std + stats.numeric[n].mean).alias(n.replace(".", "")) for c, n in zip(stats.columns(made), stats.feature_names)]
    return made.select(*back, "label").select(r6("x"), r6("x1"), "label")


def _wide(spark, folder):
    """Two rows per flow with a category of their own, so there are more categories than flows."""
    both = F.explode(F.array(*[F.concat(F.lit(side), F.col("flow_id").cast("string")) for side in "ab"]))
    return flows(spark, folder).select("flow_id", both.alias("service"))


@query("""SELECT service, dense_rank() OVER (ORDER BY service) - 1 AS place, 1e0 AS value, count(*) OVER () AS size
          FROM (SELECT unnest(['a', 'b']) || CAST(flow_id AS VARCHAR) AS service FROM flows)""")
def one_hot_wide(spark, folder):
    made = prep.one_hot_vectors(_wide(spark, folder), "service", "v").select("service", F.unwrap_udt("v").alias("v"))
    return made.select("service", F.element_at("v.indices", 1).cast("bigint").alias("place"),
                       F.element_at("v.values", 1).alias("value"), F.col("v.size").cast("bigint").alias("size"))


@query("""SELECT id, CAST((row_number() OVER (PARTITION BY class ORDER BY key) - 1) * 5 // count(*) OVER (PARTITION BY class) AS INTEGER) AS fold
          FROM (SELECT id, class, CAST('0x' || substr(md5('42:' || CAST(id AS VARCHAR)), 1, 15) AS BIGINT) AS key
                FROM (SELECT flow_id * 4 + j AS id, 'c' || CAST(flow_id * 2 + j % 2 AS VARCHAR) AS class FROM flows, range(4) AS t(j)))""")
def kfold_many_classes(spark, folder):
    rows = flows(spark, folder).select("flow_id", F.explode(F.array(*[F.lit(j) for j in range(4)])).alias("j"))
    rows = rows.select((F.col("flow_id") * 4 + F.col("j")).alias("id"),
                       F.concat(F.lit("c"), (F.col("flow_id") * 2 + F.col("j") % 2).cast("string")).alias("class"))
    return splits.stratified_folds(rows, "class", "id", method="md5").select("id", "fold")


@query(f"""SELECT flow_id, label FROM ({_KEYED}) ORDER BY key LIMIT 1000""")
def sample_n(spark, folder):
    return splits.sample_rows(flows(spark, folder), "flow_id", 1000, method="md5").select("flow_id", "label")


@query("""SELECT flow_id, label FROM flows ORDER BY flow_id LIMIT 10""")
def row_limit(spark, folder):
    return clean.first_rows(flows(spark, folder), ["flow_id"], 10).select("flow_id", "label")


@query("""SELECT label, n / (SELECT 1e0 * count(*) FROM flows) AS share, n,
            floor((SELECT count(*) FROM flows) / (4e0 * n) * 1e6 + 0.5e0) / 1e6 AS weight
          FROM (SELECT label, count(*) AS n FROM flows GROUP BY 1)""")
def class_weights(spark, folder):
    rows = flows(spark, folder)
    weights = explore.class_weights(rows, "label").withColumn("weight", half_up(F.col("weight"), 6))
    shares = explore.distribution(rows, "label").select("label", "share")
    return shares.join(weights, "label")
