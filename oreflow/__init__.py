"""oreflow: layered (bronze, silver, gold) refinement of business tables on Spark.

Everything is a Column or DataFrame function; nothing here runs Python per row.
"""
