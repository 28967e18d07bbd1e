"""Daily plan-versus-actual sales analytics on Spark."""
