"""statmart: statistical datasets and flat datamarts as Spark DataFrame jobs.

functions  column expressions (codes, numbers, dates, names, paths)
operators  star joins and flatten, per-group sequence, catalog, run log, nesting
sources    distributed scans of delimited, fixed-width, sheet, XML, JSON and zip files
sinks      table writers, range-bucket partitions, datasets as databases
plans      mart specs, parameterised SQL, registered queries with their SQL oracle
streaming  incremental file loads
"""
