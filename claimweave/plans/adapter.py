"""Claims and detections derived from the order tables, in SQL that both engines run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.functions.vocabulary import PART_CATEGORY, PART_ZONE
from claimweave.session import read_table

CLAIMS = """
select o_orderkey as claim_id,
       case c_nationkey % 8 when 0 then 'Madrid' when 1 then 'barcelona' when 2 then 'Zaragoza' when 3 then 'Sevilla'
            when 4 then 'Teruel' when 5 then 'Valencia' when 6 then 'CUENCA' end as provincia,
       case o_custkey % 7 when 0 then 'Seat' when 1 then 'VW' when 2 then 'Renault' when 3 then 'Toyota'
            when 4 then 'Ford' when 5 then 'Peugeot' else 'Tesla' end as marca,
       cast(2014 + o_custkey % 12 as int) as anio,
       cast(5000 + (o_custkey * 37) % 45000 as double) as valor,
       cast(o_custkey % 6 as int) as siniestros_12m,
       case o_orderkey % 5 when 0 then 'Golpe en el paragolpes' when 1 then 'Daño en el CAPÓ' when 2 then 'Rayón en la puerta'
            when 3 then '' end as descripcion,
       cast(o_orderdate as date) as fecha_cierre,
       case when o_orderpriority = '1-URGENT' then 'severo' when o_orderpriority in ('2-HIGH', '3-MEDIUM') then 'moderado'
            else 'leve' end as severidad_oficial,
       o_orderstatus = 'P' as es_estructural,
       o_totalprice / 250.0e0 as importe_real
from orders join customer on o_custkey = c_custkey
"""

DETECTIONS = """
select l_orderkey as claim_id,
       concat('img-', cast(l_orderkey as varchar(20)), '-', cast(l_suppkey % 3 as varchar(5))) as image_hash,
       cast(row_number() over (partition by l_orderkey
            order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) as int) as pos,
       case (l_orderkey + l_linenumber % 2) % 9 when 0 then 'scratch' when 1 then 'dent' when 2 then 'scratch'
            when 3 then 'broken_light' when 4 then 'paint_chip' when 5 then 'crack' when 6 then 'dent'
            when 7 then 'scratch' else 'puncture' end as type,
       case (l_orderkey * 7 + l_linenumber % 2) % 17 when 0 then 'front_bumper' when 1 then 'back_bumper' when 2 then 'hood'
            when 3 then 'trunk' when 4 then 'tailgate' when 5 then 'front_left_door' when 6 then 'front_right_door'
            when 7 then 'back_left_door' when 8 then 'back_right_door' when 9 then 'front_left_light'
            when 10 then 'front_right_light' when 11 then 'back_left_light' when 12 then 'back_right_light'
            when 13 then 'left_mirror' when 14 then 'right_mirror' when 15 then 'wheel' else 'unknown' end as part,
       cast(80 + cast(round(l_discount * 100) as int) * 2 as int) as conf_pct,
       (80 + cast(round(l_discount * 100) as int) * 2) / 100.0e0 as confidence,
       case when l_quantity <= 30 then 'small' when l_quantity <= 43 then 'medium' else 'large' end as extension,
       l_quantity / 5.0e0 as area_pct
from lineitem
where l_linenumber <= 3
"""


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    for name in ("orders", "customer"):
        read_table(spark, sf_dir, name).createOrReplaceTempView(name)
    return spark.sql(CLAIMS)


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with zone, category, and the fields consolidation reads."""
    read_table(spark, sf_dir, "lineitem").createOrReplaceTempView("lineitem")
    pairs = lambda table: F.create_map(*[x for k, v in table.items() for x in (F.lit(k), F.lit(v).cast("string"))])
    return spark.sql(DETECTIONS).withColumns(
        {
            "zone": F.coalesce(F.try_element_at(pairs(PART_ZONE), F.col("part")), F.lit("unknown")),
            "part_category": F.coalesce(F.try_element_at(pairs(PART_CATEGORY), F.col("part")), F.lit("unknown")),
            "severity": F.when(F.col("conf_pct") >= 98, "severo").when(F.col("conf_pct") >= 90, "moderado").when(F.col("conf_pct") >= 84, "leve"),
            "structural_suspicion": F.col("type").isin("crack", "puncture") & (F.col("conf_pct") >= 96),
        }
    )


def _case(column: str, table: dict[str, str | None]) -> str:
    return f"case {column} " + " ".join(f"when '{k}' then '{v}'" for k, v in table.items() if v) + " else 'unknown' end"


#: The same two views for the SQL side, as the head of a statement.
WITH = f"""
with claims as ({CLAIMS}),
raw_detections as ({DETECTIONS}),
detections as (
  select *, {_case("part", PART_ZONE)} as zone, {_case("part", PART_CATEGORY)} as part_category,
         case when conf_pct >= 98 then 'severo' when conf_pct >= 90 then 'moderado' when conf_pct >= 84 then 'leve' end as severity,
         type in ('crack', 'puncture') and conf_pct >= 96 as structural_suspicion
  from raw_detections
)"""
