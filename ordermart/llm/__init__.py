"""Training-data operators: dedup, quality, language, secrets, mixing, WARC,
sharding and decontamination over a corpus of documents.

One module per operator, each with a general interface over DataFrames;
``queries.py`` applies them to the driver's tables. Nothing else in the
library imports this subpackage.
"""
