"""tarn: a three-layer batch lake (Bronze, Silver, Gold) as Spark jobs.

Operators are plain ``DataFrame -> DataFrame`` functions; reading and writing
sit in ``tarn.sources`` and the jobs that chain them in ``tarn.plans``.
"""
