"""fragmill: fragment, dialogue and corpus analytics expressed as Spark jobs."""
