import math
import tempfile


from pickwise.functions.evaluator import RegretEvaluator
from pickwise.operators.prepare import Preprocessor
from pickwise.plans.models import FittedModel
from pickwise.streaming.serve_stream import serve_stream


def test_regret_evaluator(spark):
    df = spark.createDataFrame([(1, "a", 5.0, 1.0), (1, "b", 3.0, 2.0), (2, "a", 1.0, 0.0), (2, "b", 2.0, 1.0)],
                               "Demand_ID long, Plant_ID string, Cost double, prediction double")
    ev = RegretEvaluator()
    assert math.isclose(ev.evaluate(df), math.sqrt((4.0 + 0.0) / 2)) and not ev.isLargerBetter()
    neg = RegretEvaluator(metricName="neg_regret_rmse")
    assert neg.evaluate(df) < 0 and neg.isLargerBetter()


def test_stream_serving_matches_batch(spark):
    demand = spark.createDataFrame([(d, float(d)) for d in range(6)], "demand_id long, DF1 double")
    plants = spark.createDataFrame([(p, float(p) - 1.5) for p in range(4)], "plant_id long, PF1 double")
    costs = spark.createDataFrame([(d, p, float(d + p)) for d in range(6) for p in range(4)],
                                  "demand_id long, plant_id long, cost double")
    prep = Preprocessor().fit(demand, plants, costs)
    model = FittedModel("lasso", {}, ["DF1", "PF1"], intercept=1.0, coef=[1.0, -2.0])
    src = tempfile.mkdtemp(prefix="pw-src-")
    demand.write.mode("overwrite").parquet(src + "/in")
    stream = spark.readStream.schema(demand.schema).parquet(src + "/in")
    q = serve_stream(stream, model, prep, plants, src + "/out", src + "/ckpt")
    q.awaitTermination(120)
    out = spark.read.parquet(src + "/out/*").collect()
    assert len(out) == 6 and {r.selected_plant for r in out} == {3}
