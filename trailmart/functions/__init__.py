"""Column helpers: rates, calendar parts, text rules, sampling buckets."""
