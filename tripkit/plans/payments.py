"""Payment analyses (M31, M32) on the multi-year trip table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleanse as C
from ..functions import timeparts as tp
from ..operators import rollups as R
from .bindings import LI_TRIPS_SQL, li_trips, with_ctes
from .registry import register

# Payment labels by code and word.
CASH = ["2", "csh", "cash", "cas"]
CREDIT = ["1", "crd", "credit", "cre"]


def payment_types(spark, sf_dir):
    """Counts by month, amount bucket floor(x/10)*10 (C28) and payment type."""
    t = li_trips(spark, sf_dir)
    return R.count_by(t, [F.to_date(tp.trunc_ts("month", "pickup_datetime")).alias("month"),
                          C.floor_bucket("fare_amount", 10).cast("double").alias("total_amount_bucket"),
                          "payment_type"], out="count")


PT_SQL = """SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS month,
  CAST(floor(fare_amount / 10) * 10 AS DOUBLE) AS total_amount_bucket, payment_type, count(*) AS count
FROM li GROUP BY ALL"""


@register("m31_payment_types", with_ctes("SELECT * FROM pt", li=LI_TRIPS_SQL, pt=PT_SQL))
def m31_payment_types(spark, sf_dir):
    return payment_types(spark, sf_dir)


def _labelled(spark, sf_dir):
    pt = payment_types(spark, sf_dir)
    low = F.lower(F.col("payment_type").cast("string"))
    return pt.withColumn("payment_label", F.when(low.isin(*CASH), "cash").when(low.isin(*CREDIT), "credit"))


LABEL_SQL = f"""CASE WHEN lower(CAST(payment_type AS VARCHAR)) IN ({", ".join(f"'{x}'" for x in CASH)}) THEN 'cash'
  WHEN lower(CAST(payment_type AS VARCHAR)) IN ({", ".join(f"'{x}'" for x in CREDIT)}) THEN 'credit' END"""


@register("m32_credit_share_by_month", with_ctes(f"""
SELECT month, round(CAST(sum(CASE WHEN payment_label = 'credit' THEN trips ELSE 0 END) AS DOUBLE) / nullif(sum(trips), 0), 9) AS frac_credit
FROM (SELECT month, {LABEL_SQL} AS payment_label, sum(count) AS trips FROM pt GROUP BY 1, 2)
GROUP BY month""", li=LI_TRIPS_SQL, pt=PT_SQL))
def m32_credit_share_by_month(spark, sf_dir):
    """Share of credit trips per month, ELSE 0 branch (F6, T15); the label
    is grouped by its expression, not by the input column name (T7)."""
    lab = _labelled(spark, sf_dir)
    pt = lab.groupBy("month", "payment_label").agg(F.sum("count").alias("trips"))
    return pt.groupBy("month").agg(
        F.round(R.share(R.cond_sum(F.col("payment_label") == "credit", "trips"), F.sum("trips")), 9).alias("frac_credit"))


@register("m32_credit_share_by_month_band", with_ctes(f"""
SELECT month, total_amount_bucket,
  round(CAST(sum(CASE WHEN payment_label = 'credit' THEN trips ELSE 0 END) AS DOUBLE) / nullif(sum(trips), 0), 9) AS frac_credit,
  CAST(sum(trips) AS BIGINT) AS trips
FROM (SELECT month, total_amount_bucket, {LABEL_SQL} AS payment_label, sum(count) AS trips FROM pt
      WHERE total_amount_bucket >= 0 AND total_amount_bucket < 30 GROUP BY 1, 2, 3)
GROUP BY month, total_amount_bucket""", li=LI_TRIPS_SQL, pt=PT_SQL))
def m32_credit_share_by_month_band(spark, sf_dir):
    """Credit share by month and amount band 0-30."""
    lab = _labelled(spark, sf_dir).filter((F.col("total_amount_bucket") >= 0) & (F.col("total_amount_bucket") < 30))
    pt = lab.groupBy("month", "total_amount_bucket", "payment_label").agg(F.sum("count").alias("trips"))
    return pt.groupBy("month", "total_amount_bucket").agg(
        F.round(R.share(R.cond_sum(F.col("payment_label") == "credit", "trips"), F.sum("trips")), 9).alias("frac_credit"),
        F.sum("trips").cast("bigint").alias("trips"))
