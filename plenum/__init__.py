"""plenum: evidence-resolution analytics expressed as Spark DataFrame plans."""
