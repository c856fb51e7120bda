"""Reading and writing the pipeline's files."""
