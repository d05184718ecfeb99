"""spark-submit entry point: ``spark-submit --py-files plume.zip submit_job.py bronze --servers … --out …``
(see plume/streaming/jobs.py for the jobs and their options)."""

from plume.streaming.jobs import main

if __name__ == "__main__":
    main()
