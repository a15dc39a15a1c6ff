"""Reading and writing panels."""
