"""Column functions: strings, numbers, dates, JSON, coordinates."""
