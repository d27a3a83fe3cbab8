"""Column builders: text, numbers, dates, web traffic, comparisons."""
