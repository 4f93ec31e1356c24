"""tidemark: market-trend analytics on price/volume bars, written for Spark.

Every public function takes DataFrames and returns DataFrames; nothing reads a
clock (``as_of`` is always an argument) and nothing holds rows on the driver.
"""
