"""creditmart: loan-application analytics as composable Spark DataFrame operators."""
