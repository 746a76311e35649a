import os

import pytest
from pyspark.sql import functions as F

from medallion.sources.ndjson import envelope_json, read_lines, write_ndjson
from medallion.sources.seed import dim_products


def test_ndjson_sink_roundtrip_and_empty(spark, tmp):
    df = spark.createDataFrame([("e1", "2026-05-02 12:00:10")], "id string, ts string").select(
        envelope_json(F.col("id"), F.lit("order_created"), F.col("ts").cast("timestamp_ntz"),
                      F.struct(F.lit(1).alias("x"))).alias("value")
    )
    path = os.path.join(tmp, "events")
    write_ndjson(df, path)
    lines = [r.value for r in read_lines(spark, path).collect()]
    assert lines == ['{"event_id":"e1","event_type":"order_created","event_timestamp":"2026-05-02T12:00:10Z",'
                     '"event_version":"1.0","payload":{"x":1}}']
    with pytest.raises(ValueError):
        write_ndjson(df.where("false"), os.path.join(tmp, "empty"))


def test_product_seed(spark):
    p = dim_products(spark)
    assert p.count() == 20
    assert p.where("is_active").count() == 18
    cats = {r.category: r["count"] for r in p.groupBy("category").count().collect()}
    assert cats == {"ELETRONICOS": 4, "INFORMATICA": 5, "MODA": 5, "CASA": 6}
    assert dict(p.dtypes)["unit_price"] == "decimal(10,2)"
