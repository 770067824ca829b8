"""Text-edition analytics expressed as Spark DataFrame plans."""
