"""Company-registry market intelligence on Spark: readers, joins, gold tables and checks."""
