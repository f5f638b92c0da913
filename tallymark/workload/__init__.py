"""The pipelines on the test tables: relations bound to them, registered queries, and SQL that checks each query."""
