"""Sales analytics on Spark: raw text feed -> typed staging -> star -> reports."""
