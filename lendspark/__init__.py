"""Credit-portfolio analytics as Spark DataFrame operators."""
