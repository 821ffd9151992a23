"""Column functions: text, dates, fiscal periods and measures."""
