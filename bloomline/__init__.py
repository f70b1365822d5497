"""bloomline: customer-order analytics and training-data preparation as Spark jobs."""
