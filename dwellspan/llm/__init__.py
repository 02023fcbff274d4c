"""Operators that prepare text corpora for language-model training, as Spark jobs.

Rules that hold for every operator here: a null text is an empty text; repeated rows each keep their own output row
unless the operator is there to remove them; columns that an operator does not name are carried along or ignored, and
helper columns get names that the input does not use."""
