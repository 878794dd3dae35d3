"""Queries on distributions, histograms, correlations and classification quality."""

from itertools import combinations

from pyspark.sql import functions as F

from flowrisk.operators import evaluate, explore, splits
from flowrisk.operators.features import derive_features
from flowrisk.plans.queries_prepare import DERIVED, FOLDS_SQL, NUMBERS
from flowrisk.plans.registry import flows, query, r6, scored, sql6
from flowrisk.schema import CLASSES


@query("""SELECT label, count(*) AS n, count(*) / (SELECT 1e0 * count(*) FROM flows) AS share
          FROM flows GROUP BY 1""")
def class_distribution(spark, folder):
    return explore.distribution(flows(spark, folder), "label")


@query("""SELECT protocol_type, floor(100e0 * count(*) / (SELECT count(*) FROM flows) * 1e6 + 0.5e0) / 1e6 AS percent
          FROM flows GROUP BY 1""")
def category_share(spark, folder):
    shares = explore.distribution(flows(spark, folder), "protocol_type")
    return shares.select("protocol_type", (100.0 * F.col("share")).alias("percent")).withColumn("percent", r6("percent"))


@query("""SELECT flow_id, label FROM flows WHERE label IN
            (SELECT label FROM flows GROUP BY 1 HAVING count(*) >= 1000)""")
def rare_class_filter(spark, folder):
    return explore.drop_rare_classes(flows(spark, folder), "label", 1000).select("flow_id", "label")


_CELLS = ", ".join(f"count(*) FILTER (label = '{c}') AS \"{c}\"" for c in CLASSES)


@query(f"SELECT protocol_type, {_CELLS} FROM flows GROUP BY 1")
def crosstab(spark, folder):
    return explore.crosstab(flows(spark, folder), "protocol_type", "label")


_PREDICTED = ", ".join(f"count(*) FILTER (predicted_label = '{c}') AS \"pred_{c}\"" for c in CLASSES)


@query(f"SELECT label AS truth, {_PREDICTED} FROM scored GROUP BY 1", "scored")
def confusion_matrix(spark, folder):
    return evaluate.confusion_matrix(scored(spark, folder), "label", "predicted_label")


def _scores_sql(source, by=""):
    """Scores per class (and ``by``) by comparing counts of truths and predictions."""
    on = f"{by}, " if by else ""
    return f"""SELECT {on}class, tp, support, predicted,
        CASE predicted WHEN 0 THEN 0e0 ELSE tp * 1e0 / predicted END AS precision,
        CASE support WHEN 0 THEN 0e0 ELSE tp * 1e0 / support END AS recall,
        CASE tp WHEN 0 THEN 0e0 ELSE 2e0 * tp / (predicted + support) END AS f1_score
      FROM (SELECT {on}class, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(s) AS BIGINT) AS support,
              CAST(sum(p) AS BIGINT) AS predicted
            FROM (SELECT {on}label AS class, CAST(label = predicted_label AS INTEGER) AS tp, 1 AS s, 0 AS p FROM {source}
                  UNION ALL SELECT {on}predicted_label, 0, 0, 1 FROM {source}) GROUP BY ALL)"""


@query(f"""WITH per_class AS ({_scores_sql("scored")})
  SELECT entry, {sql6("precision")} AS precision, {sql6("recall")} AS recall, {sql6("f1_score")} AS f1_score, support
  FROM (SELECT class AS entry, precision, recall, f1_score, support FROM per_class
    UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT sum(tp) * 1e0 / sum(support) AS a,
      CAST(sum(support) AS BIGINT) AS n FROM per_class)
    UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1_score), CAST(sum(support) AS BIGINT) FROM per_class
    UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
      sum(f1_score * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per_class)""", "scored")
def classification_report(spark, folder):
    made = evaluate.classification_report(scored(spark, folder), "label", "predicted_label")
    return made.select("entry", r6("precision"), r6("recall"), r6("f1_score"), "support")


_FOLDED = f"SELECT s.*, fold FROM scored AS s JOIN ({FOLDS_SQL}) USING (flow_id)"
_FOLD_F1 = f"""SELECT fold, sum(f1_score * support) / sum(support) AS weighted_f1, CAST(sum(support) AS BIGINT) AS support
  FROM ({_scores_sql("folded", "fold")}) GROUP BY 1"""


def _folded(spark, folder):
    return splits.stratified_folds(scored(spark, folder), "label", "flow_id", method="md5")


@query(f"WITH folded AS ({_FOLDED}) SELECT fold, {sql6('weighted_f1')} AS weighted_f1, support FROM ({_FOLD_F1})",
       "scored")
def fold_f1(spark, folder):
    made = evaluate.fold_f1(_folded(spark, folder), "fold", "label", "predicted_label")
    return made.withColumn("weighted_f1", r6("weighted_f1"))


@query(f"""WITH folded AS ({_FOLDED}) SELECT count(*) AS cv_folds, {sql6('avg(weighted_f1)')} AS mean_f1_score,
             {sql6('stddev_pop(weighted_f1)')} AS std_f1_score FROM ({_FOLD_F1})""", "scored")
def fold_f1_summary(spark, folder):
    made = evaluate.fold_f1_summary(_folded(spark, folder), "fold", "label", "predicted_label")
    return made.select("cv_folds", r6("mean_f1_score"), r6("std_f1_score"))


_FEATURES = [*NUMBERS, *DERIVED]
_WITH_FEATURES = """SELECT *, src_bytes + dst_bytes AS total_bytes, (src_bytes + 1e0) / (dst_bytes + 1e0) AS byte_ratio,
    (src_bytes - dst_bytes) / (src_bytes + dst_bytes + 1e0) AS byte_asymmetry,
    (src_bytes + dst_bytes) / (duration + 0.001e0) AS bytes_per_sec,
    unique_dst_ports / (connections_to_same_host + 1e0) AS port_dispersion_ratio,
    failed_logins / (connections_to_same_host + 1e0) AS failed_login_ratio FROM flows"""


def _correlation_sql():
    pairs = [(a, b) for b, a in combinations(_FEATURES, 2)]
    cells = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': {sql6(f'corr({a}, {b})')}}}" for a, b in pairs)
    return f"SELECT x.a AS a, x.b AS b, x.r AS r FROM (SELECT unnest([{cells}]) AS x FROM ({_WITH_FEATURES}))"


@query(_correlation_sql())
def correlation_lower(spark, folder):
    rows = derive_features(flows(spark, folder))
    return explore.correlation(rows, _FEATURES).withColumn("r", r6("r"))


_WIDE = {f"w{j}": (7 * j + 3, 11 + 2 * j) for j in range(25)}
_WIDE_SQL = "SELECT " + ", ".join(f"(flow_id * {a} + k) % {b} * 1e0 AS {c}" for c, (a, b) in _WIDE.items()) + " FROM flows"


def _wide_sql():
    cells = ", ".join(f"{{'a': '{a}', 'b': '{b}', 'r': {sql6(f'corr({a}, {b})')}}}" for b, a in combinations(_WIDE, 2))
    return f"SELECT x.a AS a, x.b AS b, x.r AS r FROM (SELECT unnest([{cells}]) AS x FROM ({_WIDE_SQL}))"


@query(_wide_sql())
def correlation_wide(spark, folder):
    """All 300 pairs of 25 columns."""
    rows = flows(spark, folder).select(*[
        ((F.col("flow_id") * a + F.col("k")) % b).cast("double").alias(c) for c, (a, b) in _WIDE.items()])
    return explore.correlation(rows, list(_WIDE)).withColumn("r", r6("r"))


@query("SELECT protocol_type, label, count(*) AS n FROM flows GROUP BY 1, 2")
def crosstab_long(spark, folder):
    return explore.crosstab_long(flows(spark, folder), "protocol_type", "label")


@query("""SELECT bin, low + bin * width AS low, low + (bin + 1) * width AS high, coalesce(n, 0) AS n
  FROM (SELECT CAST(range AS INTEGER) AS bin FROM range(20))
  LEFT JOIN (SELECT least(CAST(floor((packet_rate - low) / width) AS INTEGER), 19) AS bin, count(*) AS n
    FROM flows, (SELECT min(packet_rate) AS low, (max(packet_rate) - min(packet_rate)) / 20 AS width FROM flows)
    GROUP BY 1) USING (bin), (SELECT min(packet_rate) AS low, (max(packet_rate) - min(packet_rate)) / 20 AS width FROM flows)""")
def hist_packet(spark, folder):
    return explore.histogram(flows(spark, folder), "packet_rate")


_HIST = ["src_bytes", "dst_bytes", "duration", "packet_rate", "connections_to_same_host", "unique_dst_ports"]


def _clipped_sql():
    long = " UNION ALL ".join(
        f"""SELECT label AS class, '{c}' AS feature, least(CAST({c} AS DOUBLE),
              (SELECT quantile_cont({c}, 0.99e0) FROM flows)) AS v FROM flows""" for c in _HIST)
    return f"""WITH long AS ({long}),
      ranges AS (SELECT class, feature, count(*) AS n_rows, min(v) AS low, (max(v) - min(v)) / 40 AS width
                 FROM long GROUP BY 1, 2)
      SELECT class, feature, bin, {sql6("low + bin * width")} AS low, n, {sql6("n / (n_rows * width)")} AS density
      FROM (SELECT class, feature, low, width, n_rows, least(CAST(floor((v - low) / width) AS INTEGER), 39) AS bin,
              count(*) AS n FROM long JOIN ranges USING (class, feature) GROUP BY ALL)"""


@query(_clipped_sql())
def hist_clipped(spark, folder):
    made = explore.clipped_histograms(flows(spark, folder), _HIST, "label")
    return made.withColumns({c: r6(c) for c in ("low", "density")})
