"""duolog: Spark DataFrame operators for two-sided, date-ordered record logs."""
