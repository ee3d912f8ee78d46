"""Product diagnosis: cleaned behaviour, daily rates, weighted score, grade and ranks."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, functions as F

from layerhouse.functions.ratios import clamp_count, safe_ratio
from layerhouse.operators.ordering import number_by_each

# Grades by lowest score.
GRADES = {85: "A级", 70: "B级", 50: "C级"}
LOWEST = "D级"


@dataclass(frozen=True)
class Scoring:
    """Weight of each rate, and the factors bringing conversion and service to percent."""

    weights: Mapping[str, float]
    service_scale: int
    conversion_scale: int = 100


# The weights of the two published scores.
DIAGNOSIS = Scoring({
    "click_rate": 0.35, "conversion_rate": 0.30, "content_interact_rate": 0.1,
    "new_user_rate": 0.1, "service_rating": 0.15,
}, service_scale=100)
VALUE = Scoring({
    "click_rate": 0.2, "conversion_rate": 0.2, "content_interact_rate": 0.2,
    "new_user_rate": 0.2, "service_rating": 0.2,
}, service_scale=20)


def cleaned(raw: DataFrame) -> DataFrame:
    """Detail rows: clamped counts, category from the name, click rate and mean price."""
    rows = raw.where(F.col("product_id").isNotNull() & (F.col("product_id") != "")).withColumns({
        c: clamp_count(F.col(c)) for c in ("traffic_cnt", "click_cnt", "sales_cnt")
    })
    return rows.withColumns({
        "category": F.get(F.split("product_name", "_"), F.lit(0)),
        "click_rate": safe_ratio(F.col("click_cnt"), F.col("traffic_cnt"), 4),
        "avg_price": safe_ratio(F.col("sales_amount"), F.col("sales_cnt"), 2),
    })


def cleaned_narrow(raw: DataFrame) -> DataFrame:
    return cleaned(raw).select(
        "product_id", "product_name", "category", "traffic_cnt", "click_cnt", "click_rate", "stat_date"
    )


def daily_rates(raw: DataFrame) -> DataFrame:
    """Rates in percent per product and day."""
    def percent(top: str, bottom: str):
        return safe_ratio(F.col(top) * 100, F.col(bottom), 2)

    return raw.withColumns({
        "click_rate": percent("click_cnt", "traffic_cnt"),
        "content_interact_rate": percent("content_interact_cnt", "traffic_cnt"),
        "new_user_rate": percent("new_user_cnt", "visitor_cnt"),
        "avg_price": safe_ratio(F.col("sales_amount"), F.col("sales_cnt"), 2),
    })


def scored(daily: DataFrame, scoring: Scoring) -> DataFrame:
    """Score, grade, five ranks within the day, and the competitiveness index."""
    scale = {"conversion_rate": scoring.conversion_scale, "service_rating": scoring.service_scale}
    # decimals, so that a score on the edge of a grade does not depend on the order of additions
    parts = [
        F.col(name).cast("decimal(14,4)") * F.lit(Decimal(str(weight * scale.get(name, 1))).quantize(Decimal("0.01")))
        for name, weight in scoring.weights.items()
    ]
    total = reduce(add, parts)
    grade = F.lit(LOWEST)
    for low in sorted(GRADES):
        grade = F.when(F.col("total_score") >= low, GRADES[low]).otherwise(grade)
    rows = daily.withColumn("total_score", F.round(total, 2)).withColumns({
        "score_level": grade,
        "competitiveness_index": F.round(F.col("total_score") * F.lit(Decimal("0.8")) + 20, 2),
    })
    ranked = number_by_each(rows, ["stat_date"], ["product_id"], {
        "traffic_rank": "click_rate", "conversion_rank": "conversion_rate",
        "content_rank": "content_interact_rate", "new_user_rank": "new_user_rate",
        "service_rank": "service_rating",
    })
    return ranked.select(
        "product_id", "product_name", "total_score", "score_level", "traffic_rank",
        "conversion_rank", "content_rank", "new_user_rank", "service_rank",
        "competitiveness_index", "stat_date",
    )
