"""Change-log operators: splitting, messages, transactions, schemas in force, compaction."""
