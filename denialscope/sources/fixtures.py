"""The ``claims`` view over the driver's TPC-H-style tables.

The test data has no claims, so claims are derived from ``lineitem`` joined
to ``orders`` by a deterministic mapping written in the SQL subset that Spark
and DuckDB both accept unchanged. Spark runs exactly this text (so Catalyst
prunes the scan to the ~8 referenced columns and plans the join), and the
DuckDB oracles embed the very same text as a CTE.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..session import compiled_methods

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

_K = """k AS (
  SELECT l.*, o.o_custkey, CAST(o.o_orderdate AS DATE) AS svc,
         l.l_orderkey * 8 + l.l_linenumber AS lk,
         (l.l_orderkey * 8 + l.l_linenumber) * 131 + l.l_partkey * 17 + l.l_suppkey AS h
  FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
)"""

_B = """b AS (
  SELECT *,
    CASE WHEN h % 10 < 6 THEN 'medical' WHEN h % 10 < 9 THEN 'pharmacy' ELSE 'dental' END AS claim_type,
    split_part('11,11,11,11,21,22,22,23,31,81,12,20,24,99', ',', CAST(1 + (h * 3) % 14 AS INT)) AS place_of_service,
    CASE WHEN h % 12 = 0 THEN 91 + h % 60 WHEN h % 12 = 1 THEN 61 + h % 30 WHEN h % 41 = 0 THEN -5 ELSE h % 45 END AS lag_days,
    split_part('E11.9,E11.65,I10,I25.10,I50.9,J44.1,J44.9,J06.9,M54.5,M17.11,M79.3,N18.3,N18.9,G47.33,K21.0,F32.1,F41.1,R10.9,Z23,Z00.00,L40.0,D64.9,B20,C50.911,G43.909', ',', CAST(1 + l_partkey % 25 AS INT)) AS d1,
    split_part('R10.9,Z23,M54.5,K21.0,D64.9,I10,L40.0', ',', CAST(1 + h % 7 AS INT)) AS d2,
    split_part('99213,99214,27447,71046,80053,90834,99203,74177,85025,96413,00000,29881,93000', ',', CAST(1 + l_partkey % 13 AS INT)) AS p1,
    split_part('99212,70553,80061,47562', ',', CAST(1 + h % 4 AS INT)) AS p2
  FROM k
)"""

_SELECT = """SELECT
  concat('CLM-', CAST(lk AS STRING), '-', CAST(l_partkey AS STRING), '-', CAST(l_suppkey AS STRING)) AS claim_id,
  concat('MBR-', lpad(CAST(o_custkey AS STRING), 6, '0')) AS member_id,
  CASE WHEN lk % 991 = 0 THEN NULL
       WHEN lk % 997 = 0 THEN concat('9', lpad(CAST(h % 1000000000 AS STRING), 9, '0'))
       WHEN lk % 1009 = 0 THEN '12345'
       ELSE concat('1', lpad(CAST(l_suppkey AS STRING), 9, '0')) END AS provider_npi,
  claim_type, place_of_service,
  CASE WHEN h % 211 = 0 THEN '' WHEN h % 223 = 0 THEN NULL WHEN h % 227 = 0 THEN 'INVALID'
       WHEN h % 3 = 0 THEN concat(d1, '|', d2) ELSE d1 END AS diagnosis_codes,
  CASE WHEN claim_type = 'pharmacy' THEN '' WHEN claim_type = 'dental' THEN concat('D', CAST(1000 + h % 8999 AS STRING))
       WHEN h % 229 = 0 THEN ' ' WHEN h % 2 = 0 THEN concat(p1, '|', p2) ELSE p1 END AS procedure_codes,
  CAST(l_extendedprice AS DOUBLE) AS billed_amount,
  CASE WHEN h % 23 = 0 THEN CAST(0 AS DOUBLE) WHEN h % 29 = 0 THEN NULL
       WHEN h % 31 = 0 THEN l_extendedprice / CAST(20 AS DOUBLE) ELSE l_extendedprice * (CAST(40 + h % 45 AS DOUBLE) / CAST(100 AS DOUBLE)) END AS allowed_amount,
  svc AS service_date,
  CASE WHEN h % 37 = 0 THEN NULL ELSE svc + CAST(lag_days AS INT) END AS submission_date,
  CASE WHEN claim_type = 'pharmacy' THEN split_part('00002323301,00074309460,59148004690,68462039710', ',', CAST(1 + h % 4 AS INT)) ELSE '' END AS drug_ndc,
  CASE WHEN claim_type = 'pharmacy' THEN CAST(30 * (1 + h % 3) AS INT) ELSE 0 END AS days_supply,
  CASE WHEN h % 233 = 0 THEN NULL ELSE CAST(18 + o_custkey % 78 AS INT) END AS member_age,
  CASE WHEN o_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS member_gender,
  split_part('internal_medicine,family_practice,cardiology,orthopedics,gastroenterology,dermatology,psychiatry,neurology,oncology,pulmonology,endocrinology,nephrology,general_surgery,emergency_medicine,radiology,anesthesiology,ophthalmology,urology,pathology,physical_therapy', ',', CAST(1 + l_suppkey % 20 AS INT)) AS provider_specialty,
  CASE WHEN (h * 7919) % 10007 < 1000
     + CASE WHEN lag_days > 90 THEN 3500 WHEN lag_days > 60 THEN 1500 WHEN lag_days > 30 THEN 500 ELSE 0 END
     + CASE WHEN l_extendedprice > 50000 THEN 1500 WHEN l_extendedprice > 25000 THEN 800 ELSE 0 END
     + ((l_suppkey * 37) % 51) * 30
     + CASE WHEN d1 LIKE 'E11%' OR d1 LIKE 'I10%' OR d1 LIKE 'J44%' OR d1 LIKE 'N18%' THEN 500 ELSE 0 END
     - CASE WHEN place_of_service = '23' THEN 1000 ELSE 0 END
     + CASE WHEN place_of_service = '21' THEN 800 ELSE 0 END
     + CASE WHEN claim_type = 'pharmacy' THEN 300 ELSE 0 END
    THEN 1 ELSE 0 END AS is_denied
FROM b"""


def claims_sql(lineitem: str = "lineitem", orders: str = "orders") -> str:
    """Stand-alone query text (``WITH k, b SELECT …``)."""
    return ("WITH " + _K.format(lineitem=lineitem, orders=orders) + ",\n" + _B + "\n" + _SELECT)


def claims_cte() -> str:
    """CTE list ending in ``claims AS (…)`` for the DuckDB oracles."""
    return (_K.format(lineitem="lineitem", orders="orders") + ",\n" + _B
            + ",\nclaims AS (\n" + _SELECT + "\n)")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims DataFrame (CLAIMS_SCHEMA columns) derived from lineitem ⨝ orders.

    Spark reads only the referenced lineitem/orders columns; the join is a
    plain equi-join on the order key, so on a cluster it is a sort-merge join
    co-partitioned by ``l_orderkey`` (or bucketed tables avoid the shuffle).
    The mapping as one generated method is longer than HotSpot compiles
    (``session.compiled_methods``).
    """
    text = claims_sql("{lineitem}", "{orders}")
    return compiled_methods(spark).sql(text, lineitem=load_table(spark, sf_dir, "lineitem"),
                     orders=load_table(spark, sf_dir, "orders"))
