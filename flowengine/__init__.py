"""Network-flow analytics and attack detection as Spark DataFrame functions."""
