"""Table builders: silver, staging, gold, marts, star schema, serving queries, run metrics, full run."""
