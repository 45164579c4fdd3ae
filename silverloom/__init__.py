"""silverloom: a PySpark-native medallion engine with contract analytics."""
