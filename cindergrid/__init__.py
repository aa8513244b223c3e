"""cindergrid: fire-weather tables evolved, matched and scored as Spark jobs."""
