"""Network flows derived from the ``events`` table, and a stand-in classifier.

The flow fields, the label and the class weights are fixed functions of the event,
so that results can be checked in any SQL engine.
"""

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowrisk.functions import risk
from flowrisk.operators.forecast import observed_attack_prob
from flowrisk.plans.scoring import add_risk
from flowrisk.schema import BENIGN, CLASSES


def read_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/events.parquet")


def flows_of(events: DataFrame) -> DataFrame:
    """One flow per event: `FLOW_SCHEMA` and the event's number ``k``."""
    k = F.col("k")
    scan, fail = F.col("event_type") == "view", F.col("event_type") == "error"
    port = F.element_at(F.array(*map(F.lit, [443, 80, 22, 21, 1433, 3306, 8080])), (k % 7 + 1).cast("int"))
    return (
        events.withColumn("k", F.regexp_extract("props", "([0-9]+)", 1).cast("bigint"))
        .select(
            F.col("event_id").alias("flow_id"), F.col("user_id").alias("host_id"), "ts", "k",
            (F.col("value") / 4.0).alias("duration"),
            (F.col("value") * 37.0 + k).alias("src_bytes"),
            (k * 23.0 + 5.0).alias("dst_bytes"),
            (F.col("value") * 8.0).alias("packet_rate"),
            (k * 4 + 1).alias("connections_to_same_host"),
            F.when(scan, 1 + k % 40).otherwise(1 + k % 3).alias("unique_dst_ports"),
            F.when(fail, k % 12).otherwise(F.lit(0).cast("bigint")).alias("failed_logins"),
            port.cast("bigint").alias("dst_port"),
            F.when(F.col("event_id") % 5 == 0, "udp").otherwise("tcp").alias("protocol_type"),
            "event_type",
        )
        .withColumn("label", F.when(scan & (F.col("unique_dst_ports") >= 20), "PortScan")
                    .when(fail & (F.col("failed_logins") >= 3), "BruteForce")
                    .when(F.col("packet_rate") >= 400.0, "DoS").otherwise("Normal"))
        .drop("event_type")
    )


def dirty(flows: DataFrame) -> DataFrame:
    """The flows with gaps, text in number columns, infinities and padded labels."""
    i = F.col("flow_id")
    return flows.withColumns({
        "src_bytes": F.when(i % 17 == 0, None).when(i % 31 == 0, "n/a")
        .otherwise(F.col("src_bytes").cast("string")),
        "duration": F.when(i % 29 == 0, "inf").otherwise(F.col("duration").cast("string")),
        "protocol_type": F.when(i % 37 != 0, F.col("protocol_type")),
        "label": F.when(i % 41 == 0, None)
        .when(i % 3 == 0, F.concat(F.lit(" \t"), F.col("label"), F.lit(" \u00a0\r"))).otherwise(F.col("label")),
    })


def classified(flows: DataFrame) -> DataFrame:
    """Add class probabilities ``p_<class>`` and the predicted label of the stand-in."""
    i, k = F.col("flow_id"), F.col("k")

    def weight(c, spread):
        return 1 + spread + F.when(F.col("label") == c, 60).otherwise(0)

    weights = {
        "BruteForce": weight("BruteForce", i * 15485863 % 79),
        "DoS": weight("DoS", (i * 104729 + k * 17) % 89),
        "Normal": weight("Normal", (i * 7919 + k * 31) % 97),
        "PortScan": weight("PortScan", (i * 1299709 + k) % 83),
    }
    df = flows.select("*", *[w.alias(f"_w_{c}") for c, w in weights.items()])
    total = sum((F.col(f"_w_{c}") for c in CLASSES[1:]), F.col(f"_w_{CLASSES[0]}"))
    df = df.select("*", *[(F.col(f"_w_{c}").cast("double") / total).alias(f"p_{c}") for c in CLASSES])
    # Equal weights give equal probabilities, so the label can be read off either.
    label = risk.predicted_label({c: F.col(f"_w_{c}") for c in CLASSES})
    return df.withColumn("predicted_label", label).drop(*[f"_w_{c}" for c in CLASSES])


def detections(flows: DataFrame) -> DataFrame:
    """Classified flows with risk columns and the trend's attack probability."""
    df = add_risk(classified(flows), CLASSES)
    return df.withColumn("forecast_attack_prob", observed_attack_prob(F.col(f"p_{BENIGN}")))
