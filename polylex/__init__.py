"""polylex: a PySpark engine for multilingual, concept-linked document corpora."""
