"""Reading and writing: files, tables, exports."""
