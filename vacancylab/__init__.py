"""vacancylab - job-postings analytics on Spark.

Operators are plain DataFrame -> DataFrame functions over six tables
(postings, positions, employers, regions, ai_tags, tech_tags); see README.md.
"""

__version__ = "0.1.0"
