"""larder: a PySpark toolkit for curating and searching collections of text records and images."""
