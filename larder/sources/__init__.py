"""Reading and writing datasets."""
