"""hourprofile: PySpark operators for wide hourly count data.

* ``functions``  -- column expressions (keys, tolerant casts, hour picks, level)
* ``operators``  -- DataFrame -> DataFrame operators (project, filters, profile,
  encode, model, messages, score, joins)
* ``sources`` / ``sinks`` -- files, message logs, Kafka and JDBC option layers
* ``streaming``  -- publish, score and upsert-fold Structured Streaming jobs
* ``plans``      -- the batch jobs, the driver-table views, registered queries
  and their SQL oracle
"""
