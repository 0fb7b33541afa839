"""flowspark: flow analytics, alert rules and page-view features as Spark jobs."""
