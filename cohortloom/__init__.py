"""Cohort curation on Spark: table operators from DataFrame to DataFrame, and Column expressions."""
