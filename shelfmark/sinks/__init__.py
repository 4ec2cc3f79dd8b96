"""Writers: file exports, the landing store, topics, keyed tables, JDBC."""
