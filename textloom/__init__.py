"""Text-dataset preparation, labelling, exploration and scoring as Spark jobs."""
