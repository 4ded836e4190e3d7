"""Video-corpus preparation on Spark: spans, picks, transcripts, vectors and their bookkeeping as DataFrame plans."""
