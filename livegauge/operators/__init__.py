"""Single relational steps the jobs are made of."""
