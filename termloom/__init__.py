"""termloom: text-mining analytics expressed as PySpark DataFrame jobs."""
