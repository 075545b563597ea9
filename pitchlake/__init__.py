"""Match-event analytics on Spark: raw JSON to Bronze, Silver, Gold and reports."""
