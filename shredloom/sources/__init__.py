"""Reading filings, crosswalks and stored tables; writing tables, CSV and reports."""
