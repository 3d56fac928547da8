"""tripspark: trip-duration analytics as Spark DataFrame / SQL / ML / Structured Streaming jobs.

Layout:
    sources/    parquet scan + sinks, bronze landing, JDBC sink options, models, prediction log
    functions/  column expressions (time features, flag encoding, log target, path segment)
    operators/  profile, null policy, dedup, outlier rules, grouped analytics, correlation,
                histogram, machine learning
    plans/      composite jobs: bronze -> silver, train, score; SQL forms of the analytics
    streaming/  Structured Streaming scoring
"""

__version__ = "0.1.0"
