"""riskflow: card-transaction risk analytics as PySpark DataFrame, ML and streaming operators."""
