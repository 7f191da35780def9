"""Knowledge-event analytics on Spark: event logs, documents, knowledge graphs and reports."""
