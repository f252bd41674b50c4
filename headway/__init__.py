"""headway: transit delay and reliability analytics on PySpark."""
