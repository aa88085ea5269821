"""Reading and writing: feeds, layer tables, staging, publishing."""
