"""rotativa: news-headline analytics as Spark jobs.

Landed front pages become headline rows, headline rows become a partitioned
dataset with a catalog table, and that dataset feeds reports, quality checks, a
relational sink, text features and classifiers.  Everything is a DataFrame plan.
"""
