"""Supply-chain and finance analytics as Spark DataFrame operators."""
