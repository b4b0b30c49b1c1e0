"""Writers: partitioned lake, published tables, delimited files."""
