"""A Spark engine for annotating text corpora: layers, dependency forests and structural detectors as DataFrames."""
