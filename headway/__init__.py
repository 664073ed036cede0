"""headway: batch analytics over public-transport schedule data, on PySpark."""
