"""lexiflow: annotated-corpus processing and lemmatisation scoring on Spark DataFrames.

Every operator is a plain function DataFrame -> DataFrame built from Catalyst
expressions, joins, aggregates and windows. Python runs inside tasks only for
the alignment DP (``operators.align``) and the ROUGE-L subsequence
(``operators.evaluate``), both over distinct word pairs, and for the SVD Gram
sum (``operators.projection``); never on the driver over data.
"""

__version__ = "0.1.0"
