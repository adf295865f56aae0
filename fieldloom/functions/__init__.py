"""Part of fieldloom; see README.md."""
