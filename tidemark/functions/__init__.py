"""Column functions: text, dates, labels and the chi-squared tail."""
