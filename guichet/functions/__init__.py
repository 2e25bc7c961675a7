"""Column functions: text masking and detection, dates, pseudonyms."""
