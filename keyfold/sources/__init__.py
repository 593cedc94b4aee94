"""Change-record sources: envelope parsing, derived change logs, file/topic readers."""
