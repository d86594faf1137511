"""mercato: a real-time retail warehouse written as PySpark DataFrame operators.

Every operator takes and returns DataFrames and works the same on a static
table and on a streaming one, except where Spark refuses a form on streams
(``count_distinct``, ``left_anti``); those operators take a ``streaming`` flag.
"""

__version__ = "0.1.0"
