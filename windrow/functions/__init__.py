"""Column functions: text splitting, JSON messages, clocks and reports."""
