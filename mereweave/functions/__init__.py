"""Column functions: identifiers, text, dates, scores."""
