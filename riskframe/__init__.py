"""riskframe: tabular risk analytics as Spark DataFrame operators."""
