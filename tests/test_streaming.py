"""The cleaning chain gives the same rows as a stream as in batch."""

import tempfile

from conftest import SF_SMALL
from civicflow import schema as S
from civicflow.operators.cleaning import clean_pipeline
from civicflow.sources import requests_ev
from civicflow.streaming import clean_stream, write_clean_stream
from pyspark.sql import functions as F


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="civicflow-src-")
    out = tempfile.mkdtemp(prefix="civicflow-out-")
    ckpt = tempfile.mkdtemp(prefix="civicflow-ckpt-")
    raw = requests_ev(spark, SF_SMALL)
    full = raw.select(*[F.col(f.name) if f.name in raw.columns
                        else F.lit(None).cast(f.dataType).alias(f.name) for f in S.RAW.fields])
    full.repartition(3).write.mode("overwrite").parquet(src)
    q = write_clean_stream(clean_stream(spark, src), out, checkpoint=ckpt)
    q.awaitTermination(300)
    got = spark.read.parquet(out)
    want = clean_pipeline(spark.read.schema(S.RAW).parquet(src))
    assert got.count() == want.count()
    cols = ["unique_key", "complaint_category", "response_time_days", "zip_code"]
    assert sorted(got.select(*cols).collect()) == sorted(want.select(*cols).collect())
