"""Analytics pipelines for yard and fulfilment operations, on Spark."""
