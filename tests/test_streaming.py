"""A fitted model scores a file stream exactly as it scores the batch."""

import math

from churnlens.operators import encode, models
from churnlens.schema import FIXTURE
from churnlens.sources.fixture_view import subscriber_view
from churnlens.streaming.scoring import start_scoring


def test_stream_scores_equal_batch(spark, scratch):
    v = subscriber_view(spark, "/root/testdata/sf0.001")
    spec = encode.fit_model_features(v, FIXTURE)
    m = models.fit_logistic(v, spec, FIXTURE.label)
    v.write.parquet(f"{scratch}/in")
    stream = spark.readStream.schema(v.schema).parquet(f"{scratch}/in")
    q = start_scoring(m, stream, FIXTURE.key, f"{scratch}/out", f"{scratch}/ckpt")
    q.awaitTermination(120)
    got = {r[FIXTURE.key]: r["prob"] for r in spark.read.parquet(f"{scratch}/out").collect()}
    exp = {r[FIXTURE.key]: r["prob"] for r in m.score(v).collect()}
    assert got.keys() == exp.keys() and all(math.isclose(got[k], exp[k]) for k in exp)
