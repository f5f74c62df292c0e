"""Reading laboratory tables and writing report datasets."""
