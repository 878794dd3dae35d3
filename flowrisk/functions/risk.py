"""Risk score, level, alert and advice of one detection as column expressions.

All of them take the predicted label and two nullable probabilities: that of the
benign class and that of the predicted class. NULL means the classifier gave none.
"""

from collections.abc import Mapping

from pyspark.sql import Column, functions as F

from flowrisk.functions.numeric import clamp, half_up
from flowrisk.schema import (
    ALERT_SCORE, BENIGN, CONCURRENT_CLASSES, CONCURRENT_MIN_PROBABILITY,
    CONFIDENCE_WEIGHT, DEFAULT_SEVERITY, LEVELS, PLAYBOOK, SEVERITY, SEVERITY_WEIGHT,
)


def _lookup(table: Mapping, key: Column, default) -> Column:
    items = [F.lit(x) for pair in table.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*items), key), F.lit(default))


def probability_of(label: Column, by_class: Mapping[str, Column]) -> Column:
    """Probability of the predicted class out of one column per class."""
    return F.coalesce(*[F.when(label == name, p) for name, p in by_class.items()])


def _best(by_class: Mapping[str, Column]) -> Column:
    p = list(by_class.values())
    return F.greatest(*p) if len(p) > 1 else p[0]


def predicted_label(by_class: Mapping[str, Column]) -> Column:
    """Class of highest probability; ties go to the first class name in the alphabet."""
    best = _best(by_class)
    return F.coalesce(*[F.when(by_class[name] == best, F.lit(name)) for name in sorted(by_class)])


def confidence(by_class: Mapping[str, Column]) -> Column:
    return half_up(_best(by_class), 4)


def is_attack(label: Column) -> Column:
    return label != BENIGN


def attack_probability(label: Column, p_benign: Column, p_label: Column) -> Column:
    """Unrounded probability that the flow is not benign."""
    return (
        F.when(p_benign.isNotNull(), 1.0 - p_benign)
        .when(label == BENIGN, 1.0 - F.coalesce(p_label, F.lit(0.0)))
        .otherwise(F.coalesce(p_label, F.lit(1.0)))
    )


def severity(label: Column) -> Column:
    return _lookup(SEVERITY, label, DEFAULT_SEVERITY)


def risk_score(label: Column, p_benign: Column, p_label: Column, attack_p: Column) -> Column:
    """0 to 100; ``attack_p`` is the unrounded `attack_probability`."""
    benign = F.greatest(F.lit(0.0), (1.0 - F.coalesce(p_benign, F.lit(0.0))) * CONFIDENCE_WEIGHT)
    sure = F.coalesce(p_label, attack_p)
    attack = clamp(severity(label) * SEVERITY_WEIGHT + sure * CONFIDENCE_WEIGHT, 0.0, 100.0)
    return half_up(F.when(label == BENIGN, benign).otherwise(attack), 2)


def risk_level(score: Column) -> Column:
    *graded, (lowest, _) = LEVELS
    level = F.lit(lowest)
    for name, bound in reversed(graded):
        level = F.when(score >= bound, name).otherwise(level)
    return level


def alert_triggered(label: Column, score: Column) -> Column:
    return is_attack(label) | (score >= ALERT_SCORE)


def recommendation(label: Column) -> Column:
    return _lookup(PLAYBOOK, label, PLAYBOOK["Other"])


def concurrent_attack(label: Column, by_class: Mapping[str, Column]) -> Column:
    """More than one attack class is likely at once, on a flow predicted as attack."""
    likely = [
        F.coalesce((by_class[c] >= CONCURRENT_MIN_PROBABILITY).cast("int"), F.lit(0))
        for c in CONCURRENT_CLASSES if c in by_class
    ]
    return is_attack(label) & (sum(likely, F.lit(0)) > 1)


def rounded_probabilities(probabilities: Column) -> Column:
    return F.transform_values(probabilities, lambda _, p: half_up(p, 4))


def verdict_columns(label: Column, score: Column) -> dict[str, Column]:
    """What follows from label and score. A later projection than the score's, so that
    the score is computed once."""
    return {
        "is_attack": is_attack(label),
        "risk_level": risk_level(score),
        "alert_triggered": alert_triggered(label, score),
        "recommendation": recommendation(label),
    }
