"""Plans: staging and mart models, reports, the pipeline and the query registry."""
