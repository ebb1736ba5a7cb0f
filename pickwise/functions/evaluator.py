"""Selection-regret evaluator for MLlib tuning tools.

``RegretEvaluator`` scores a prediction table by the RMSE of the per-group
selection regret (scenario table, one partial aggregate). Smaller is better;
``metricName='neg_regret_rmse'`` returns the negated value (larger is
better), the convention of the reference's scorer."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import functions as F


class RegretEvaluator(Evaluator):
    groupCol = Param(Params._dummy(), "groupCol", "scenario (demand) column", TypeConverters.toString)
    itemCol = Param(Params._dummy(), "itemCol", "candidate (plant) column", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "actual cost column", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "predicted cost column", TypeConverters.toString)
    metricName = Param(Params._dummy(), "metricName", "regret_rmse or neg_regret_rmse", TypeConverters.toString)

    def __init__(self, groupCol="Demand_ID", itemCol="Plant_ID", labelCol="Cost", predictionCol="prediction",
                 metricName="regret_rmse"):
        super().__init__()
        self._setDefault(groupCol="Demand_ID", itemCol="Plant_ID", labelCol="Cost", predictionCol="prediction",
                         metricName="regret_rmse")
        self._set(groupCol=groupCol, itemCol=itemCol, labelCol=labelCol, predictionCol=predictionCol,
                  metricName=metricName)

    def _evaluate(self, dataset) -> float:
        from ..operators.regret import regret_rmse_expr, scenario_table
        g = self.getOrDefault(self.groupCol)
        if g not in dataset.columns:
            raise ValueError("group ids must be provided to the regret evaluator")
        scen = scenario_table(dataset, demand=g, plant=self.getOrDefault(self.itemCol),
                              cost=self.getOrDefault(self.labelCol), pred=self.getOrDefault(self.predictionCol))
        value = scen.agg(F.coalesce(regret_rmse_expr(), F.lit(0.0))).first()[0]
        return -value if self.getOrDefault(self.metricName) == "neg_regret_rmse" else value

    def isLargerBetter(self) -> bool:
        return self.getOrDefault(self.metricName) == "neg_regret_rmse"
