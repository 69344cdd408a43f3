"""headwater: rule-driven signal analytics expressed as Spark DataFrame and Column functions."""
