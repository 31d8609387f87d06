"""Column functions: text, dates, URLs, geography and alert levels."""
