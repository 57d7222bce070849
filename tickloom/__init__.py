"""tickloom: daily-bar signal analytics on Spark."""
