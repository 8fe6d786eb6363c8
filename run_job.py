"""Launcher for spark-submit: ``spark-submit --py-files civicflow.zip run_job.py clean ...``."""

from civicflow.jobs import main

if __name__ == "__main__":
    main()
