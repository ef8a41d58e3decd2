"""Table models, the pipeline over them, and ad-hoc SQL jobs."""
