"""Column functions shared by the table builders; all of them stay inside generated JVM code."""
