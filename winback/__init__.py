"""winback: customer-reactivation analytics as composable Spark DataFrame operators."""
