"""gneiss: entity resolution, risk analytics and corpus preparation on Spark."""
