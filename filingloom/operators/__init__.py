"""Jobs on manifests, filings, tables, sections and chunks."""
