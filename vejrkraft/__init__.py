"""vejrkraft: hourly energy and weather analytics as Spark jobs."""
