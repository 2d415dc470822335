"""spark-submit launcher for the contact export (see clientele/plans/contact_job.py).

Only the driver imports ``clientele``: every operator is a built-in Spark
expression, so executors need no Python package.
"""

from clientele.plans.contact_job import main

if __name__ == "__main__":
    main()
