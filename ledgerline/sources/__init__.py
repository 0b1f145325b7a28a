"""Sources and sinks: test-bed ERP tables, extraction and landing."""
