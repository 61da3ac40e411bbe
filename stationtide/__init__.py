"""stationtide: a PySpark engine for in-situ observation data.

Raw station tables are mapped onto one long observation model, cut into
time x latitude x longitude tiles, catalogued and retrieved, all as DataFrame
operations that Spark partitions, shuffles and spills.
"""

__version__ = "0.1.0"
